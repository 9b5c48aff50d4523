"""Operator 7: information-theoretic sanitisation of personal data.

Protected entities (e-mail addresses, IP addresses, card and phone numbers) are
found by patterns.  Corpus co-occurrence then tells how strongly the words
of a text reveal an entity e that it mentions: a term t in ``co`` of the
documents that mention e, at any distance, discloses PMI(t; e) =
log2(co * N / (df_t * df_e)) of the entity's information
IC(e) = log2(N / df_e).  Terms above the upper threshold are
removed, those above the lower one generalised to a placeholder, beside the
entities themselves.  N, df and co cover all documents.  Everything is built
from DataFrame functions; there is no Python on the main path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.llm.common import cut

#: Fixed patterns.  Possessive repeats and the looks around them only say that
#: a match is a whole run; they find what the plain patterns find.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_WORD = r"[^\x20\t-\r]+"

#: Stands for an entity while words are told apart.
_MARK = "\ue000"
#: Distinct documents that must show a term with an entity.
SUPPORT = 3
REMOVE, GENERALISE = 0.9, 0.7
_SPAN = "array<struct<s:int,k:int,e:int,v:string>>"


def _found(text: F.Column, pattern: str, kind: int, offset: F.Column | None = None) -> F.Column:
    """Spans (start, kind, end, value) of all matches: the pieces between the
    matches and the matches' own lengths add up to the positions."""
    base = F.lit(0) if offset is None else offset
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    start = F.struct(base.cast("int").alias("p"), F.array().cast(_SPAN).alias("out"))

    def step(acc, x):
        s = acc["p"] + F.length(x["g"])
        e = s + F.length(x["v"])
        span = F.struct(s.alias("s"), F.lit(kind).alias("k"), e.alias("e"), x["v"].alias("v"))
        return F.struct(e.alias("p"), F.concat(acc["out"], F.array(span)).alias("out"))
    pairs = F.zip_with(values, F.slice(gaps, 1, F.greatest(F.size(values), F.lit(0))),
                       lambda v, g: F.struct(v.alias("v"), g.alias("g")))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _passes(span: F.Column) -> F.Column:
    digits = F.regexp_replace(span["v"], "[^0-9]", "")
    return (F.when(span["k"] == 0, F.lit(True))
            .when(span["k"] == 1, span["v"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
            .when(span["k"] == 2, F.call_function("luhn_check", digits))
            .otherwise(F.length(digits).between(9, 15)))


def entity_spans(text: F.Column) -> F.Column:
    """All base spans of a text column by start, then kind."""
    none = F.array().cast(_SPAN)
    digit = text.rlike("[0-9]")
    need = {"email": F.contains(text, F.lit("@")), "ip": digit, "card": digit,
            "phone": F.contains(text, F.lit("+"))}
    parts = [F.when(need[k], _found(text, PATTERNS[k], i)).otherwise(none)
             for i, k in enumerate(KINDS)]
    return F.array_sort(F.filter(F.concat(*parts), _passes))


def _listed(spans: F.Column, names: list[str]) -> F.Column:
    kinds = F.array(*[F.lit(n) for n in names])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(kinds, x["k"] + 1), x["s"], x["e"])), ",")


def _cleaned(text: F.Column, spans: F.Column, names: list[str],
             mark: F.Column | None = None) -> F.Column:
    """The text with each span replaced: entities and generalised terms by their
    kind in brackets, removed terms by nothing; or every span by ``mark``."""
    marks = F.array(*[F.lit("" if n == "removed" else f"[{n.upper()}]") for n in names])

    def step(acc, x):
        fresh = x["s"] >= acc["p"]
        kept = F.substring(text, acc["p"] + 1, x["s"] - acc["p"])
        return F.struct(
            F.greatest(acc["p"], x["e"]).alias("p"),
            F.when(fresh, F.concat(acc["out"], kept, F.element_at(marks, x["k"] + 1)
                                   if mark is None else mark))
            .otherwise(acc["out"]).alias("out"))
    start = F.struct(F.lit(0).alias("p"), F.lit("").alias("out"))
    return F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["p"] + 1, F.length(text))))


def _text_terms(texts: DataFrame) -> DataFrame:
    """(text_key, term): distinct words of each text, outside every entity span."""
    blank = _cleaned(F.translate("text", _MARK, " "), F.col("spans"), list(KINDS),
                     F.lit(_MARK))
    words = F.filter(F.array_distinct(F.split(F.lower(blank), r"[\x20\t-\r]+")),
                     lambda w: (w != "") & ~F.contains(w, F.lit(_MARK)))
    return texts.select("text_key", F.explode(words).alias("term"))


def _term_spans(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text_key, s, e, removed): every place of the wanted (text_key, term,
    removed), outside every entity span."""
    some = texts.join(wanted.select("text_key").distinct(), "text_key", "left_semi")
    pieces = some.select("text_key", F.posexplode(F.regexp_extract_all(
        F.col("text"), F.lit(rf"[\x20\t-\r]*{_WORD}"), F.lit(0))).alias("i", "piece"))
    word = F.regexp_replace("piece", r"^[\x20\t-\r]+", "")
    places = pieces.select(
        "text_key", F.lower(word).alias("term"), F.length(word).alias("n"),
        F.sum(F.length("piece")).over(Window.partitionBy("text_key").orderBy("i"))
        .cast("int").alias("e")).withColumn("s", F.col("e") - F.col("n"))
    return (places.join(wanted, ["text_key", "term"])
            .join(texts.select("text_key", "spans"), "text_key")
            .where(~F.exists("spans", lambda y: (F.col("s") < y["e"]) & (y["s"] < F.col("e"))))
            .select("text_key", "s", "e", "removed"))


def disclosing_terms(docs: DataFrame, marked: DataFrame, support: int, remove: float,
                     generalise: float) -> DataFrame:
    """(text_key, s, e, removed): the words of each text that disclose an entity
    which the text mentions."""
    texts = marked.select("text_key", "text", "spans").dropDuplicates(["text_key"])
    copies = marked.groupBy("text_key").agg(F.count("*").alias("copies"))
    mentions = (texts.select("text_key", F.explode("spans").alias("m"))
                .select("text_key", F.concat_ws(":", F.col("m.k"), F.lower("m.v")).alias("entity"))
                .distinct().join(copies, "text_key"))
    # an entity of fewer texts has no term of enough texts
    entities = cut(mentions.groupBy("entity").agg(
        F.sum("copies").alias("df_e"), F.count("*").alias("texts"))
        .where(F.col("texts") >= support).drop("texts"))
    mentions = cut(mentions.join(entities.select("entity"), "entity"))
    some = texts.join(mentions.select("text_key").distinct(), "text_key", "left_semi")
    co = (mentions.join(_text_terms(some), "text_key").groupBy("entity", "term")
          .agg(F.sum("copies").alias("co"), F.count("*").alias("texts"))
          .where(F.col("texts") >= support))
    words = F.array_distinct(F.split(F.lower(F.col("text")), r"[\x20\t-\r]+"))
    terms = (docs.select(F.explode(words).alias("term")).groupBy("term")
             .agg(F.count("*").alias("df_t")))
    scored = (co.join(terms, "term").join(entities, "entity")
              .withColumn("n", docs.agg(F.count("*")).scalar())
              .withColumn("ratio", F.log2(F.col("co") * F.col("n") / (F.col("df_t") * F.col("df_e")))
                          / F.log2(F.col("n") / F.col("df_e")))
              .where((F.col("n") > F.col("df_e")) & (F.col("ratio") >= generalise)))
    wanted = cut(mentions.join(scored, "entity").groupBy("text_key", "term").agg(
        F.max(F.col("ratio") >= remove).alias("removed"))
        .join(_text_terms(some), ["text_key", "term"], "left_semi"))
    return _term_spans(texts, wanted)


def sanitise(docs: DataFrame, support: int = SUPPORT, remove: float = REMOVE,
             generalise: float = GENERALISE) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms,
    clean_text) for every row.

    ``spans`` lists kind:start:end (code points, end exclusive) by start, then
    in the order email, ip, card, phone, removed, term.  Added spans are all
    places of words, at any distance from a mention, that stand in at least
    ``support`` distinct texts with the same entity and whose disclosure ratio
    reaches the thresholds; ratios equal to a threshold count.  ``clean_text`` is null
    where nothing is to be changed.  Null and empty texts have no spans (the
    digest of the empty string); texts without mentions are left alone.
    Repeated rows each give a row and count as documents.  An empty table gives
    no rows.  Only ``doc_id`` and ``text`` are read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = docs.withColumn("spans", entity_spans(F.col("text")))
    some = F.size("spans") > 0
    base = cut(found.select("doc_id", "spans", F.when(some, F.col("text")).alias("text"),
                            F.when(some, F.md5("text")).alias("text_key")))
    marked = base.where(some)
    found = disclosing_terms(docs, marked, support, remove, generalise)
    added = (found.groupBy("text_key").agg(F.collect_set(F.struct(
                 F.col("s"), F.when(F.col("removed"), 4).otherwise(5).alias("k"), F.col("e"),
                 F.lit("").alias("v"))).alias("added")))
    names = [*KINDS, "removed", "term"]
    base_list = _listed(F.col("spans"), names)

    def count(kind: int) -> F.Column:
        return F.size(F.filter("spans", lambda x: x["k"] == kind)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    done = marked.join(added, "text_key", "left").withColumn(
        "every", F.when(F.col("added").isNull(), F.col("spans"))
        .otherwise(F.array_sort(F.concat("spans", F.col("added").cast(_SPAN)))))
    with_spans = done.select(
        "doc_id", *counts, F.sha2(base_list, 256).alias("base_sha256"),
        _listed(F.col("every"), names).alias("spans"),
        (F.size("every") - F.size("spans")).cast("long").alias("n_terms"),
        _cleaned(F.col("text"), F.col("every"), names).alias("clean_text"))
    zero = F.lit(0).cast("long")
    without = base.where(~some).select(
        "doc_id", *[zero.alias(f"n_{k}") for k in KINDS],
        F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans"),
        zero.alias("n_terms"), F.lit(None).cast("string").alias("clean_text"))
    return with_spans.unionAll(without)
