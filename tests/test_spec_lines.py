"""Table specs as lines of JSON against the one-document reader."""

import json

from pyspark.sql import functions as F

from dimflow.sinks import fs
from dimflow.sources import spec_lines as SL
from dimflow.sources.specs import read_spec_columns, read_table_specs
from tests.test_io import SPEC_B


def _lines(spark, groups):
    rows = [(g, i, json.dumps(t)) for g, group in enumerate(groups)
            for i, t in enumerate(group["tables"])]
    return spark.createDataFrame(rows, "group int, index int, spec string").repartition(3)


def _rows(df):
    return sorted(map(str, df.select(*[F.to_json(F.struct(c)) for c in sorted(df.columns)])
                      .collect()))


def test_lines_give_what_the_document_gives(spark, tmp_path):
    doc = str(tmp_path / "schema.json")
    fs.write_text_file(spark, doc, json.dumps(SPEC_B))
    path = SL.write_spec_lines(_lines(spark, SPEC_B["groups"]), str(tmp_path / "lines"),
                               SPEC_B["version"])
    lines = SL.read_lines(spark, path)
    assert _rows(SL.table_specs(lines)) == _rows(read_table_specs(spark, doc)[0])
    assert _rows(SL.spec_columns(lines)) == _rows(read_spec_columns(spark, doc))
    assert SL.bad_lines(lines).count() == 0 and SL.other_options(lines).count() == 0


def test_wrong_types_unknown_options_and_bad_lines(spark, tmp_path):
    text = [
        '{"version":"1","group":0,"index":0,"table":{"name":"t","columns":"oops","delimiter":";",'
        '"reject_max":"many","keep":{"days":[1,2]},"note":null}}',
        '{"version":"1","group":0,"index":1,"table":{"columns":[]}}',
        '{"version":"1","group":0,', "", "[1]", "null"]
    path = str(tmp_path / "lines.txt")
    fs.write_text_file(spark, path, "\n".join(text))
    lines = SL.read_lines(spark, path)
    (spec,) = SL.table_specs(lines).collect()
    assert (spec.name, spec.delimiter, spec.reject_max, spec.columns) == ("t", ";", None, None)
    (option,) = SL.other_options(lines).select("name", "option", F.to_json("value").alias("v")).collect()
    assert tuple(option) == ("t", "keep", '{"days":[1,2]}')
    assert sorted(tuple(r) for r in SL.bad_lines(lines).collect()) == sorted(
        [(text[1], True), (text[2], False), (text[4], True), (text[5], True)])


def test_empty_document_and_parts(spark, tmp_path):
    none = SL.write_spec_lines(_lines(spark, SPEC_B["groups"]).where("false"), str(tmp_path / "none"))
    assert SL.table_specs(SL.read_lines(spark, none)).count() == 0
    many = SL.write_spec_lines(
        spark.range(0, 2000, 1, 8).select(F.lit(0).alias("group"), F.col("id").alias("index"),
                                          F.format_string('{"name":"t%d"}', "id").alias("spec")),
        str(tmp_path / "many"))
    assert len([n for n in fs.list_names(spark, many) if n.startswith("part-")]) == 8
    assert SL.table_specs(SL.read_lines(spark, many)).count() == 2000
