"""Queries for column lists and schema lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.functions.typemap import NORMALISED_TYPES
from dimflow.operators import projection as P
from dimflow.operators import registry as R
from dimflow.plans.catalog import register
from dimflow.plans.fixtures import fixture, with_fixtures


def _norm_case(col: str) -> str:
    arms = " ".join(
        "when {c} in ({names}) then '{norm}'".format(
            c=col, names=", ".join(f"'{n}'" for n in names), norm=norm)
        for norm, names in NORMALISED_TYPES.items())
    return f"case {arms} else {col} end"


SPEC = """
select table_name, is_sql,
 case when is_sql then a when coalesce(m, '') <> '' then coalesce(k, '') || ',' || m else coalesce(k, '') end as columns,
 cast(case when is_sql then 0 else n_dropped end as bigint) as n_dropped
from (select s.table_name, bool_or(q.table_name is not null) as is_sql,
  string_agg(output_name, ',' order by pos) as a,
  string_agg(output_name, ',' order by pos) filter (where field_type = 'KEY') as k,
  string_agg(output_name, ',' order by pos) filter (where field_type = 'METRIC') as m,
  count(*) filter (where field_type not in ('KEY', 'METRIC')) as n_dropped
 from fx_part_spec_columns s left join (select distinct table_name from fx_registry where view_name <> '') q
   on q.table_name = s.table_name group by s.table_name) t"""


@register("spec_columns", with_fixtures(SPEC, "fx_part_spec_columns", "fx_registry"))
def q_spec_columns(spark, sf):
    """Load column lists -- KEYs then METRICs, or entry order for SQL specs
    (here: the tables read through a view)."""
    reg = fixture(spark, sf, "fx_registry")
    sql_tables = reg.where(F.col("view_name") != "").select("table_name")
    return P.spec_columns(fixture(spark, sf, "fx_part_spec_columns"), sql_tables)


@register("schema_lines", with_fixtures(f"""
with v as (select table_name as t, view_name as v from fx_registry where view_name <> ''),
lines as (
 select coalesce(v.t, d.table_name) as table_name, cast(d.ordinal as bigint) as ordinal,
  replace(d.table_name || ' ' || d.column_name || ' - - - - - ' || {_norm_case('d.data_type')} || ' - "ends ''\\001''"',
          d.table_name, coalesce(v.t, d.table_name)) as line
 from fx_part_dictionary d left join v on v.v = d.table_name)
select distinct table_name, cast(0 as bigint) as ordinal, table_name || ' - - - - - - format - -' as line from lines
union all select * from lines""", "fx_part_dictionary", "fx_registry"))
def q_schema_lines(spark, sf):
    """Sidecar lines with normalised types, views renamed to their tables."""
    views = fixture(spark, sf, "fx_registry").select("table_name", "view_name")
    return P.schema_lines(fixture(spark, sf, "fx_part_dictionary"), views)


@register("column_dictionary", with_fixtures("""
select d.table_name, d.column_name, d.data_type, w.pos as ordinal from fx_part_dictionary d
 join fx_wanted_columns w on w.table_name = d.table_name and w.column_name = d.column_name""",
                                             "fx_part_dictionary", "fx_wanted_columns"))
def q_column_dictionary(spark, sf):
    """Dictionary rows of the requested columns, in request order."""
    return P.column_dictionary(fixture(spark, sf, "fx_part_dictionary"), fixture(spark, sf, "fx_wanted_columns"))


@register("order_by_list", with_fixtures("""
select table_name, column_name, cast(coalesce(list_position(['updated_at', 'name', 'id'], column_name), 0) as bigint)
   as list_rank
 from (select table_name, unnest(string_split(coalesce(mysql_keys, stats_keys), ',')) as column_name from fx_registry) t""",
                                         "fx_registry"))
def q_order_by_list(spark, sf):
    """Columns ranked by an explicit list (field()/decode() order)."""
    cols = R.extract_columns(fixture(spark, sf, "fx_registry")).select("table_name", "column_name")
    return P.order_by_list(cols, "column_name", ["updated_at", "name", "id"]) \
        .withColumn("list_rank", F.col("list_rank").cast("bigint"))
