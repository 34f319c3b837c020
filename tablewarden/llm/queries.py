"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontam, jaccard, lengths, lines, mixing, quality, sharding, spans, spelling, suffixes, turns, url_lists

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into shards 0 to 39 by the hash tree; grown_shard: with a 41st."""
    return sharding.shard_rows(table(spark, sf_dir, "documents"), 40)


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels that are not held out."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _days(column: str, salt: str, within: int):
    """A whole number below ``within`` from the md5 of salt and column."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col(column).cast("string"))), 1, 8), 16, 10).cast("long") % within


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages against dated lists of the hosts in them.

    Pages carry neither fetch times nor lists: the day of a fetch comes from a hash of
    page_id, and the entries (add, remove, add again) from hashes of list and host.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", _days("page_id", "fetch", 1000).alias("fetched_at"))
    hosts = pages.select(url_lists.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    named = hosts.withColumn("list", F.explode(F.array(*[F.lit(x) for x in ("adult", "mirror", "spam")])))
    named = named.withColumn("own", F.concat("list", F.lit("|"), "host"))
    # every third host of a list is listed under its parent domain
    labels = F.split("host", r"\.")
    parent = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    named = named.where(_days("own", "in", 3) == 0).withColumn(
        "domain", F.when((F.size(labels) > 2) & (_days("own", "up", 3) == 0), parent).otherwise(F.col("host"))
    )
    start, stay, gap = _days("own", "start", 500), _days("own", "stay", 300) + 1, _days("own", "gap", 300)
    step = lambda action, at: F.struct(F.lit(action).alias("action"), at.alias("at"))
    steps = F.array(step("add", start), step("remove", start + stay), step("add", start + stay + gap))
    entries = named.select("list", "domain", F.inline(steps))
    return url_lists.filter_urls(pages, entries)


ORACLE["op3_url_filters"] = r"""
with p as (
  select page_id, url, ('0x' || substr(md5('fetch' || page_id::varchar), 1, 8))::bigint % 1000 as fetched_at,
         rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.') as host,
         row_number() over () as r
  from pages),
hosts as (select distinct host from p where host <> ''),
named as (select host, list, list || '|' || host as own, string_split(host, '.') as labels
          from hosts cross join (values ('adult'), ('mirror'), ('spam')) v(list)),
h as (select *,
        ('0x' || substr(md5('in' || own), 1, 8))::bigint % 3 as h_in, ('0x' || substr(md5('up' || own), 1, 8))::bigint % 3 as h_up,
        ('0x' || substr(md5('start' || own), 1, 8))::bigint % 500 as h_start,
        ('0x' || substr(md5('stay' || own), 1, 8))::bigint % 300 + 1 as h_stay,
        ('0x' || substr(md5('gap' || own), 1, 8))::bigint % 300 as h_gap
      from named),
listed as (select list, h_start, h_stay, h_gap,
             case when len(labels) > 2 and h_up = 0 then labels[-2] || '.' || labels[-1] else host end as domain
           from h where h_in = 0),
entries as (
  select list, domain, false as removes, h_start as tm from listed
  union all select list, domain, true, h_start + h_stay from listed
  union all select list, domain, false, h_start + h_stay + h_gap from listed),
states as (select list, domain, tm, bool_or(removes) as removes from entries group by all),
-- the as-of rule: the last entry at or before the fetch decides
m as (
  select p.r, s.list, s.domain, arg_max(s.removes, s.tm) as removes
  from p join states s on (p.host = s.domain or ends_with(p.host, '.' || s.domain)) and s.tm <= p.fetched_at
  where len(string_split(p.host, '.')) = 1 or len(string_split(s.domain, '.')) > 1
  group by p.r, s.list, s.domain),
a as (select r, count(*) as n_active, array_to_string(list_sort(list_distinct(list(list))), ',') as lists
      from m where not removes group by r)
select page_id, url, fetched_at, host, coalesce(n_active, 0) as n_active, coalesce(lists, '') as lists,
       coalesce(n_active, 0) > 0 as blocked
from p left join a using (r)
"""


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 35 words that start more than once, removed from every document."""
    return spans.drop_repeated_spans(table(spark, sf_dir, "documents"), 35)


@query
def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors by inner product of every vec_id divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), 20, 20)


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in 13-word windows of benchmark items."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of all documents for every context limit that is a document's length."""
    lengths_of = lengths.encoded_lengths(table(spark, sf_dir, "documents").select("text")).select("length")
    return lengths.suffix_sums(lengths.histogram(lengths_of))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds, dropped from every document."""
    return lines.drop_repeated_lines(table(spark, sf_dir, "documents"))


ORACLE["op8_line_dedup"] = r"""
with l as (
  select doc_id, i, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents)),
k as (select key, min(doc_id) as owner from l where length(key) >= 10 group by key having count(distinct doc_id) > 1),
j as (select l.*, k.owner is not null and k.owner <> doc_id as gone from l left join k using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from j group by doc_id
"""


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 3-word Jaccard similarity of 0.9."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), 3, (90, 100))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents' sources at weights 5, 2, 1 takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op10_mixing"] = r"""
with d as (
  select doc_id, coalesce('0' || source, '1') as src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('mix|' || coalesce(doc_id::varchar, '')) as o
  from documents),
s as (select src, sum(size)::bigint as source_size from d group by src),
w as (select *, [5.0::double, 2.0::double, 1.0::double][((row_number() over (order by encode(src))) - 1) % 3 + 1] as weight,
             source_size * 2.0::double as cap from s),
p as (
  select *, ((sum(source_size) over ())::double * 1.5::double
             - coalesce(sum(cap) over (order by cap / weight, encode(src) rows between unbounded preceding and 1 preceding), 0.0::double))
            / sum(weight) over (order by cap / weight, encode(src) rows between current row and unbounded following) as price
  from w),
t as (select *, least(cap, max(price) over () * weight) as target, floor(least(cap, max(price) over () * weight) + 1e-6)::bigint as whole from p),
a as (
  select d.*, t.source_size, t.target, t.whole,
         (coalesce(sum(size) over (partition by src order by o, doc_id rows between unbounded preceding and 1 preceding), 0))::bigint as pos
  from d join t using (src))
select doc_id, size, source_size, target,
       (greatest(0, least(size, whole - pos)) + greatest(0, least(size, whole - source_size - pos)))::bigint as taken
from a
"""


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its audit of every conversation, after planted damage."""
    conversations = table(spark, sf_dir, "conversations")
    return turns.audit(turns.damage(conversations), conversations)


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 400 bytes that start more than once, removed from every document."""
    return suffixes.drop_repeated_bytes(table(spark, sf_dir, "documents"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their more frequent spellings, after planted deletions."""
    return spelling.variants(spelling.damaged_words(table(spark, sf_dir, "documents")))
