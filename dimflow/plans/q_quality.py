"""Queries for completeness checks and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.operators import quality as Q
from dimflow.plans.catalog import register
from dimflow.plans.fixtures import fixture, with_fixtures

CHECK = """
select batch, cast(sum(greatest(nf - nm, 0)) as bigint) as n_extra, cast(sum(greatest(nm - nf, 0)) as bigint) as n_missing,
 bool_or(hasm) and sum(greatest(nf - nm, 0)) = 0 and sum(greatest(nm - nf, 0)) = 0 as complete
from (select coalesce(f.batch, m.batch) as batch, coalesce(nf, 0) as nf, coalesce(nm, 0) as nm, m.batch is not null as hasm
  from (select batch, name, count(*) as nf from fx_files where name not in ('manifest.json', 'MANIFEST') group by batch, name) f
  full join (select batch, name, count(*) as nm from fx_manifest group by batch, name) m
  on f.batch = m.batch and f.name = m.name) j
group by batch"""


def _files(spark, sf):
    return fixture(spark, sf, "fx_files"), fixture(spark, sf, "fx_manifest")


@register("file_diff", with_fixtures("""
select batch, name, 'extra' as side from (select batch, name from fx_files except all select batch, name from fx_manifest) a
union all
select batch, name, 'missing' as side from (select batch, name from fx_manifest except all select batch, name from fx_files) b""",
                                     "fx_files", "fx_manifest"))
def q_file_diff(spark, sf):
    """Files vs manifest entries, both directions, per batch."""
    return Q.file_diff(*_files(spark, sf))


@register("manifest_check", with_fixtures(CHECK, "fx_files", "fx_manifest"))
def q_manifest_check(spark, sf):
    """M1: batch completeness for all batches in one count join."""
    return Q.manifest_check(*_files(spark, sf))


@register("ready_batches", with_fixtures(f"""
with c as ({CHECK}),
s as (select batch, bool_or(name = '_SUCCESS') as has_success from fx_files group by batch),
d as (select dep.batch, min(coalesce(dc.complete, false)) as dep_ok from fx_batch_deps dep
      left join c dc on dc.batch = dep.dep_batch group by dep.batch)
select c.batch, coalesce(s.has_success, false) or (c.complete and coalesce(d.dep_ok, true)) as ready
from c left join d on d.batch = c.batch left join s on s.batch = c.batch""",
                                         "fx_files", "fx_manifest", "fx_batch_deps"))
def q_ready_batches(spark, sf):
    """Q1 + Q3: a batch loads when it and its dependency are complete, or it has _SUCCESS."""
    files, manifest = _files(spark, sf)
    checks = Q.manifest_check(files, manifest)
    return Q.ready_batches(checks, fixture(spark, sf, "fx_batch_deps"), Q.has_success(files))


@register("has_files", with_fixtures("""
select b.batch, coalesce(n, 0) > 0 as has_files from (select distinct batch from fx_manifest) b
 left join (select batch, count(*) as n from fx_files group by batch) f on f.batch = b.batch""",
                                     "fx_files", "fx_manifest"))
def q_has_files(spark, sf):
    """Q2: the any-file rule for every batch a manifest names."""
    files, manifest = _files(spark, sf)
    return Q.has_files(files, manifest.select("batch"))


@register("has_success", with_fixtures("""
select batch, bool_or(name = '_SUCCESS') as has_success from fx_files group by batch""", "fx_files"))
def q_has_success(spark, sf):
    """Q3."""
    return Q.has_success(fixture(spark, sf, "fx_files"))


@register("not_yet_loaded", with_fixtures("""
select distinct database_name, table_name, processed_utc_hour from fx_load_log t
 where process_name = 'TRANSFER' and status = 'COMPLETED'
   and not exists (select 1 from fx_load_log l where l.process_name = 'LOAD' and l.status = 'COMPLETED'
     and l.database_name = t.database_name and l.table_name = t.table_name and l.processed_utc_hour = t.processed_utc_hour)""",
                                          "fx_load_log"))
def q_not_yet_loaded(spark, sf):
    """Q8: transferred batches with no completed load yet."""
    log = fixture(spark, sf, "fx_load_log")
    cand = log.where((F.col("process_name") == "TRANSFER") & (F.col("status") == "COMPLETED")) \
        .select("database_name", "table_name", "processed_utc_hour").distinct()
    return Q.not_yet_loaded(cand, log)
