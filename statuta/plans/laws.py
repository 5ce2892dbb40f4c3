"""Queries over versioned laws: the reference capabilities on the tables of a folder, each over whole tables.

A law is a gsn of ``fassung``; rows arrive in the order of rec_id. "Newest" is a law's last version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import law_text as t
from ..functions import sequences as seq
from ..operators import catalog as cat
from ..operators import diffing, quality
from ..operators import versions as ver
from ..operators.history import DeltaStore
from ..operators.ranking import with_place
from ..operators.snapshot_diff import changes
from ..operators.xml_sections import outcomes, parse_sections, sections_of_index, unknown_tags
from ..sources.stored import stored
from ..sources.tables import table

TODAY = "2010-06-30"
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def section_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fassung").select(F.col("gsn").alias("abbrev"), "fassung_vom", "section_id", "heading", "body", "section_type", F.col("rec_id").alias("arrival"))


def snapshot(spark: SparkSession, d: str) -> DataFrame:
    return ver.build_snapshot(section_rows(spark, d))


def normalized(spark: SparkSession, d: str) -> DataFrame:
    """Normalised sections of every version, stored, as most queries read them several times."""
    return stored(ver.normalize_sections(numbered(spark, d)))


def version_table(spark: SparkSession, d: str) -> DataFrame:
    """abbrev, fassung_vom, seq of every version, from the keys of the rows."""
    return ver.versions_of(section_rows(spark, d))


def numbered(spark: SparkSession, d: str) -> DataFrame:
    return ver.with_seq(snapshot(spark, d), version_table(spark, d))


def newest(sections: DataFrame) -> DataFrame:
    last = F.max("fassung_vom").over(Window.partitionBy("abbrev"))
    return sections.withColumn("_last", last).where("fassung_vom = _last").drop("_last")


def consecutive(sections: DataFrame, versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Old and new sides of all consecutive versions, both by abbrev and fassung_vom of the new one."""
    dates = versions.select(*ver.VERSION, "seq").withColumn("next_date", F.lead("fassung_vom").over(Window.partitionBy("abbrev").orderBy("seq")))
    rows = sections.select("abbrev", "fassung_vom", "section_id", "heading", "body", "section_type").join(dates, ver.VERSION)
    old = rows.where("next_date is not null").drop("fassung_vom", "seq").withColumnRenamed("next_date", "fassung_vom")
    return old, rows.where("seq > 1").drop("seq", "next_date")


def n_sql(x: str) -> str:
    parts = "".join(f" when regexp_matches({x}, '{p}\\.?[_ ]?(\\d+[a-z]?)\\b') then '{p}_' || regexp_extract({x}, '{p}\\.?[_ ]?(\\d+[a-z]?)\\b', 1)" for p in ("§", "Art", "Anlage"))
    return f"case when regexp_matches({x}, '^Art_[^_]+_§_\\d+[a-z]?(?:_\\d+)?$') or regexp_matches({x}, '^(§|Art\\.?|Anlage)_\\d+[a-z]?\\)?$') then {x}{parts} else {x} end"


def x_sql(b: str) -> str:
    w = "\\s*[,.]?\\s*(?:Paragraph|Absatz|Paragraf)"
    both = "Art\\.?\\s*([IVXLCDM]+[a-z]?|\\d+[a-z]?)[\\s,.]*§\\.?\\s*(\\d+[a-z]?)" + w
    rules = [("§_", "§\\.?\\s*(\\d+[a-z]?)" + w), ("Art_", "Art\\.?\\s*(\\d+[a-z]?)\\s*[,.]?\\s"), ("Anlage_", "Anlage\\s+(\\d+[a-z]?)"), ("§_", "(?:^|\\n)\\s*(?:§|Paragraf|Paragraph|Paragraphen)\\s+(\\d+[a-z]?)\\s*[.,)\\s]")]
    mid = "".join(f" when regexp_matches({b}, '{p}') then '{k}' || regexp_extract({b}, '{p}', 1)" for k, p in rules)
    lone = "§\\s+(\\d+[a-z]?)(?:\\s|$)"
    return f"case when {b} is null or length({b}) < 5 then null when regexp_matches({b}, '{both}') then 'Art_' || regexp_extract({b}, '{both}', 1) || '_§_' || regexp_extract({b}, '{both}', 2){mid} when length({b}) < 300 and regexp_matches({b}, '{lone}') then '§_' || regexp_extract({b}, '{lone}', 1) end"


def label_sql(s: str) -> str:
    both = "^Art_([^_]+)_§_(\\d+[a-z]?)(?:_\\d+)?$"
    return f"""case when regexp_matches({s}, '{both}') then 'Art. ' || regexp_extract({s}, '{both}', 1) || ' § ' || regexp_extract({s}, '{both}', 2) || '.'
      when regexp_matches({s}, '^§_(\\d+[a-z]?)(?:_\\d+)?$') then '§ ' || regexp_extract({s}, '^§_(\\d+[a-z]?)(?:_\\d+)?$', 1) || '.'
      when regexp_matches({s}, '^Art_([^_]+)(?:_\\d+)?$') then 'Art. ' || regexp_extract({s}, '^Art_([^_]+)(?:_\\d+)?$', 1)
      when starts_with({s}, 'Anlage_') then replace({s}, 'Anlage_', 'Anlage ') when starts_with({s}, 'Section-') then {s}
      when length({s}) > 80 then left(replace({s}, '_', ' '), 77) || '...' else replace({s}, '_', ' ') end"""


def bad_sql(h: str) -> str:
    return f"({h} is null or {h} = '' or {h} = 'Text' or {h} = 'Beachte für folgende Bestimmung' or starts_with({h}, '(Anm'))"


def display_sql(s: str, h: str) -> str:
    return f"case when {bad_sql(h)} then {label_sql(s)} when starts_with(ltrim({h}), regexp_replace({label_sql(s)}, '\\.+$', '')) then {h} else ({label_sql(s)}) || ' ' || {h} end"


P_PREFIX = "^(?:Art(?:ikel)?\\.?\\s*(?:[IVXLCDM]+|\\d+)\\s*)?§\\s*\\d+[a-z]?\\.\\s+"
A_PREFIX = "^Art(?:ikel)?\\.?\\s*[IVXLCDM]+\\s+"


def strip_sql(b: str) -> str:
    return f"case when regexp_matches({b}, '{P_PREFIX}') then regexp_replace({b}, '{P_PREFIX}', '') when regexp_matches({b}, '{A_PREFIX}') then regexp_replace({b}, '{A_PREFIX}', '') else {b} end"


def para_sql(b: str) -> str:
    return f"list_filter(list_transform(string_split(regexp_replace(coalesce({b}, ''), '(\\(\\d+[a-z]?\\))', chr(1) || '\\1', 'g'), chr(1)), lambda p: trim(p, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))), lambda p: p <> '')"


def roman_sql(x: str) -> str:
    v = lambda i: f"coalesce(list_extract([1, 5, 10, 50, 100, 500, 1000], strpos('IVXLCDM', nullif(substr(upper({x}), cast({i} as integer), 1), ''))), 0)"
    return f"case when {x} = '' then 0 when regexp_matches(upper({x}), '^[IVXLCDM]+$') then cast(list_sum(list_transform(range(1, length({x}) + 1), lambda i: case when {v('i')} >= {v('i + 1')} then {v('i')} else -{v('i')} end)) as integer) end"


def key_sql(s: str) -> list[str]:
    """Eight expressions to order ids by, nulls first."""
    both, simple = "^Art_([^_]+)_§_(\\d+)([a-z]?)(?:_(\\d+))?$", "^([^_]*)_(\\d+)([a-z]?)(?:_(\\d+))?$"
    g = lambda p, k, x=s: f"regexp_extract({x}, '{p}', {k})"
    n = lambda x: f"try_cast(nullif({x}, '') as integer)"
    is_both, is_simple, has = f"regexp_matches({s}, '{both}')", f"regexp_matches({s}, '{simple}')", f"contains({s}, '_')"
    art, rest, hashed = g(both, 1), f"substr({s}, strpos({s}, '_') + 1)", n(g("^Section-(\\d+)", 1))
    rank = f"case string_split({s}, '_')[1] when '§' then 0 when 'Art' then 1 when 'Anlage' then 2 else 3 end"
    ra, rr, an = roman_sql(art), roman_sql(rest), n(g("^(\\d+)[a-z]?$", 1, art))
    return [
        f"case when {is_both} then 1 when {has} then {rank} when {hashed} is not null then 3 else 4 end",
        f"case when {is_both} then case when ({ra}) is not null then 1 else 0 end when {is_simple} then 0 when {has} and ({rr}) is not null then 1 else 0 end",
        f"case when {is_both} then coalesce({ra}, {an}, 0) when {is_simple} then {n(g(simple, 2))} when {has} then coalesce({rr}, {hashed}, 0) else coalesce({hashed}, 0) end",
        f"case when {is_both} then case when ({ra}) is not null then '' when {an} is not null then {g('^[0-9]+([a-z]?)$', 1, art)} else {art} end when {is_simple} then {g(simple, 3)} when {has} and ({rr}) is not null then '' when {hashed} is not null then '' else {s} end",
        f"case when {is_both} then 0 when {is_simple} then coalesce({n(g(simple, 4))}, 0) end",
        f"case when {is_both} then {n(g(both, 2))} end",
        f"case when {is_both} then {g(both, 3)} end",
        f"case when {is_both} then coalesce({n(g(both, 4))}, 0) end",
    ]


def order_sql(s: str = "section_id") -> str:
    return ", ".join(f"{x} nulls first" for x in key_sql(s))


SNAP = """snap as (select gsn as abbrev, fassung_vom, section_id, heading, body, section_type, rec_id as arrival from fassung
  where gsn is not null and fassung_vom is not null and section_id is not null and body <> ''
  qualify row_number() over (partition by gsn, fassung_vom, section_id order by length(body) desc, rec_id) = 1)"""
VERS = f"""{SNAP}, vers as (select abbrev, fassung_vom, cast(row_number() over (partition by abbrev order by fassung_vom) as integer) as seq from (select distinct abbrev, fassung_vom from snap))"""
NORM = f"""{VERS}, named as (select snap.*, seq, {n_sql("section_id")} as named, {x_sql("body")} as found from snap join vers using (abbrev, fassung_vom)),
 keyed as (select *, case when section_id = 'Text' then null when starts_with(named, 'Section-') then coalesce(found, named) else named end as sid from named),
 norm as (select abbrev, fassung_vom, seq, sid as section_id, heading, body, section_type, arrival from keyed where sid is not null
   qualify row_number() over (partition by abbrev, fassung_vom, sid order by length(body) desc, arrival) = 1)"""
RULES = f"""{NORM}, one as (select abbrev, section_id from norm where seq = 1 and not starts_with(section_id, 'Section-') and section_id <> 'Text'),
 cnt as (select n.abbrev, n.fassung_vom, n.seq, count(*) as total, count(*) filter (not starts_with(n.section_id, 'Section-') and n.section_id <> 'Text') as proper,
    count(*) filter (starts_with(n.section_id, 'Section-')) as hashed, count(one.section_id) as common
   from norm n left join one on n.abbrev = one.abbrev and n.section_id = one.section_id group by all),
 base as (select abbrev, total as t1, proper as p1, hashed as h1 from cnt where seq = 1),
 flags as (select cnt.*, t1, p1, h1, max(case when seq > 1 and proper > 1.3 * p1 and proper >= 10 then 1 else 0 end) over (partition by abbrev order by seq) = 1 as fuller from cnt join base using (abbrev)),
 rules as (select *, rule = 'overlay' and (p1 < 20 or h1 / greatest(t1, 1) > 0.4) and fuller as drop_first from (select *,
   case when seq = 1 or proper >= 30 then 'own' when proper >= 5 and common < 0.4 * proper then case when h1 > 0.2 * t1 and t1 > total then 'first' else 'own' end else 'overlay' end as rule from flags))"""
ASOF = f"""{RULES}, spans as (select *, lead(seq) over (partition by abbrev, section_id order by seq) as until from norm),
 recon as (
  select r.abbrev, r.fassung_vom, r.seq, n.section_id, n.heading, n.body, n.seq as written_seq from rules r join norm n on r.abbrev = n.abbrev and r.seq = n.seq where rule = 'own'
  union all select r.abbrev, r.fassung_vom, r.seq, n.section_id, n.heading, n.body, 1 from rules r join norm n on r.abbrev = n.abbrev and n.seq = 1 where rule = 'first'
  union all select r.abbrev, r.fassung_vom, r.seq, s.section_id, s.heading, s.body, s.seq from rules r join spans s on r.abbrev = s.abbrev and s.seq <= r.seq and (s.until is null or r.seq < s.until)
   where rule = 'overlay' and not (drop_first and s.seq = 1))"""
DIFF = f"""{VERS}, nxt as (select *, lead(fassung_vom) over (partition by abbrev order by seq) as next_date from vers),
 o as (select s.abbrev, next_date as fassung_vom, section_id, heading, body, section_type from snap s join nxt using (abbrev, fassung_vom) where next_date is not null),
 n as (select s.abbrev, s.fassung_vom, section_id, heading, body, section_type from snap s join nxt using (abbrev, fassung_vom) where seq > 1),
 diff as (select coalesce(o.abbrev, n.abbrev) as abbrev, coalesce(o.fassung_vom, n.fassung_vom) as fassung_vom, coalesce(o.section_id, n.section_id) as section_id,
   case when n.section_id is not null then coalesce(n.heading, '') else coalesce(o.heading, o.section_id) end as heading, o.body as old_body, n.body as new_body,
   case when coalesce(o.body, '') = coalesce(n.body, '') then 'unchanged' when coalesce(o.body, '') = '' then 'added' when coalesce(n.body, '') = '' then 'removed' else 'changed' end as change_kind,
   o.section_type as old_type, n.section_type as new_type
  from o full outer join n on o.abbrev = n.abbrev and o.fassung_vom = n.fassung_vom and o.section_id = n.section_id)"""
CHG = f"""{NORM}, nxt as (select *, lead(fassung_vom) over (partition by abbrev order by seq) as next_date from vers),
 o as (select s.abbrev, next_date as fassung_vom, section_id, body from norm s join nxt using (abbrev, fassung_vom) where next_date is not null),
 n as (select s.abbrev, s.fassung_vom, section_id, body from norm s where seq > 1),
 chg as (select coalesce(o.abbrev, n.abbrev) as abbrev, coalesce(o.fassung_vom, n.fassung_vom) as fassung_vom, coalesce(o.section_id, n.section_id) as section_id,
   case when o.section_id is null then 'added' when n.section_id is null then 'removed' else 'modified' end as change_kind
  from o full outer join n on o.abbrev = n.abbrev and o.fassung_vom = n.fassung_vom and o.section_id = n.section_id where o.body is distinct from n.body)"""
LISTS = f"""{CHG}, ids as (select abbrev, fassung_vom, list(section_id order by {order_sql()}) as l from chg group by all), lists as (select v.abbrev, v.fassung_vom, v.seq, coalesce(l, []) as changed from vers v left join ids using (abbrev, fassung_vom))"""
CATALOG = "cat as (select gsn, name, abbrev, typ, cat_id from law_catalog_merged where gsn is not null qualify row_number() over (partition by gsn order by cat_id desc) = 1)"
CLEAN = "regexp_replace(trim(replace(coalesce({0}, ''), chr(160), ' ')), '^\\d+\\.\\s+', '')"
NN = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({0}, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))), '\\s+', ' ', 'g'), '\\b(19|20)\\d{{2}}\\b', '', 'g'), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
LAW = f"{CATALOG}, law as (select gsn, coalesce(name, '') as name, trim(coalesce(abbrev, '')) as abbrev, coalesce(typ, '') as typ from cat), ent as (select entry_id, trim(coalesce(index_name, '')) as index_name, trim(coalesce(index_abbrev, '')) as index_abbrev from final_gsn_list)"


FLAG = "flag as (select gsn, bool_or(coalesce(abbrev in (select index_abbrev from final_gsn_list where index_abbrev is not null), false)) as listed from law_versions where gsn is not null group by gsn)"


def _named(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """``rows`` with the law's name in the catalog and whether another list has its abbreviation."""
    names = cat.deduplicated(table(spark, d, "law_catalog_merged")).select(F.col("gsn").alias("abbrev"), t.clean_law_name(F.col("name")).alias("name"))
    flags = synthetic_flag(spark, d).where("gsn is not null").groupBy(F.col("gsn").alias("abbrev")).agg(F.bool_or("listed").alias("listed"))
    return rows.join(names, "abbrev", "left").join(flags, "abbrev", "left").fillna("", ["name"]).fillna(False, ["listed"])


# --- scans and versions


@query(f"with {VERS} select abbrev, fassung_vom, section_id, heading, body from snap qualify fassung_vom = max(fassung_vom) over (partition by abbrev)")
def snapshot_scan(spark, d):
    """The newest snapshot of each law as it was delivered."""
    return newest(snapshot(spark, d)).select("abbrev", "fassung_vom", "section_id", "heading", "body")


@query(f"with {VERS} select abbrev, fassung_vom, seq, cast(row_number() over (partition by abbrev order by seq desc) as integer) as newest_first from vers")
def version_log(spark, d):
    v = version_table(spark, d)
    return v.withColumn("newest_first", F.row_number().over(Window.partitionBy("abbrev").orderBy(F.desc("seq"))))


@query("select distinct gsn as abbrev from fassung where gsn is not null")
def law_list(spark, d):
    return section_rows(spark, d).where("abbrev is not null").select("abbrev").distinct().orderBy("abbrev")


@query(f"with {VERS} select abbrev, fassung_vom, heading, body from snap where section_id = '§_1'")
def section_lookup(spark, d):
    """One section of every version; the id reaches the scan as a pushed filter."""
    return snapshot(spark, d).where("section_id = '§_1'").select("abbrev", "fassung_vom", "heading", "body")


@query("select event_id, coalesce(json_extract_string(props, '$.k'), '') as k, coalesce(json_extract_string(props, '$.page'), '') as page, coalesce(json_extract_string(props, '$.missing'), '') as missing from events")
def json_extract_defaults(spark, d):
    """Fields of a JSON text, an empty text where one is missing."""
    path = lambda p: F.coalesce(F.get_json_object("props", f"$.{p}"), F.lit("")).alias(p)
    return table(spark, d, "events").select("event_id", path("k"), path("page"), path("missing"))


@query(f"with {VERS} select abbrev, fassung_vom, section_id, body from snap")
def json_snapshot_explode(spark, d):
    """Each version written as one JSON map of sections and read back into rows."""
    entry = F.struct("section_id", F.struct("heading", "body"))
    as_json = snapshot(spark, d).groupBy(*ver.VERSION).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("j"))
    back = as_json.select(*ver.VERSION, F.explode(F.from_json("j", "map<string,struct<heading:string,body:string>>")).alias("section_id", "s"))
    return back.select(*ver.VERSION, "section_id", "s.body")


@query("select distinct nor_id from fassung where nor_id is not null and nor_id not in (select nor_id from nor_xml where nor_id is not null and nutzdaten <> '')")
def cache_miss_anti(spark, d):
    """Provisions that sections name and that have not been fetched with content."""
    held = table(spark, d, "nor_xml").where("nutzdaten != ''").select("nor_id")
    return table(spark, d, "fassung").where("nor_id is not null").select("nor_id").distinct().join(held, "nor_id", "left_anti")


@query("select distinct gsn from law_catalog_merged where gsn is not null and gsn not in (select gsn from law_versions where gsn is not null)")
def pending_anti(spark, d):
    """Laws of the catalog without a version so far."""
    return table(spark, d, "law_catalog_merged").where("gsn is not null").select("gsn").distinct().join(table(spark, d, "law_versions").select("gsn"), "gsn", "left_anti")


@query("select version_id, abbrev || ' [' || fassung_vom || ']: ' || left(coalesce(aenderung, ''), 120) as message from law_versions")
def format_version_message(spark, d):
    return table(spark, d, "law_versions").select("version_id", t.version_message(F.col("abbrev"), F.col("fassung_vom"), F.col("aenderung")).alias("message"))


@query("""select version_id, case when regexp_matches(message, p) then regexp_extract(message, p, 1) end as abbrev, case when regexp_matches(message, p) then regexp_extract(message, p, 2) end as fassung_vom,
  case when regexp_matches(message, p) then trim(regexp_extract(message, p, 3)) end as aenderung from (select *, '^(.+?)\\s+\\[([^\\]]+)\\]:\\s*(.*)' as p from law_versions)""")
def parse_version_message(spark, d):
    return table(spark, d, "law_versions").select("version_id", t.parse_version_message(F.col("message")).alias("m")).select("version_id", "m.*")


@query("""select version_id, case when regexp_matches(message, p) then regexp_extract(message, p, 1) end as abbrev, case when regexp_matches(message, p) then regexp_extract(message, p, 2) end as fassung_vom
  from (select *, '^(?:\\S{7,}\\s+)?(\\S+)\\s+\\[([^\\]]+)\\]:' as p from law_versions)""")
def parse_version_message_cli(spark, d):
    return table(spark, d, "law_versions").select("version_id", t.parse_version_message_cli(F.col("message")).alias("m")).select("version_id", "m.*")


@query("select gsn, fassung_vom, version_id from law_versions qualify row_number() over (partition by gsn, fassung_vom order by committed_at desc nulls last, version_id desc) = 1")
def resolve_version(spark, d):
    return ver.resolve_version(table(spark, d, "law_versions"))


@query(f"with {VERS} select abbrev, coalesce(max(fassung_vom) filter (fassung_vom <= '{TODAY}'), max(fassung_vom)) as fassung_vom from vers group by abbrev")
def newest_effective(spark, d):
    return ver.newest_effective(version_table(spark, d), TODAY)


@query(f"with {SNAP} select abbrev, fassung_vom, section_id, heading, body, section_type, arrival from snap")
def build_snapshot(spark, d):
    return snapshot(spark, d)


@query("select gsn, fassung_vom, version_id, aenderung from law_versions qualify row_number() over (partition by gsn, fassung_vom order by version_id) = 1")
def group_by_date_first(spark, d):
    return ver.group_by_date_first(table(spark, d, "law_versions"))


@query(f"""with {VERS}, first as (select gsn, fassung_vom, aenderung from law_versions qualify row_number() over (partition by gsn, fassung_vom order by version_id) = 1)
  select v.abbrev, v.fassung_vom, v.seq, count(*) as sections, left(coalesce(max(f.aenderung), ''), 120) as aenderung from vers v join snap using (abbrev, fassung_vom) left join first f on f.gsn = v.abbrev and f.fassung_vom = v.fassung_vom group by all""")
def build_history(spark, d):
    """Every version with its number, its sections and the amendment that brought it."""
    counted = numbered(spark, d).groupBy(*ver.VERSION, "seq").agg(F.count("*").alias("sections"))
    first = ver.group_by_date_first(table(spark, d, "law_versions")).select(F.col("gsn").alias("abbrev"), "fassung_vom", "aenderung")
    return counted.join(first, ver.VERSION, "left").withColumn("aenderung", F.left(F.coalesce("aenderung", F.lit("")), F.lit(120)))


@query("select abbrev, gsn from law_catalog_merged where abbrev <> '' qualify row_number() over (partition by abbrev order by cat_id) = 1")
def invert_map_first(spark, d):
    return cat.first_gsn_of_abbrev(table(spark, d, "law_catalog_merged"))


@query(f"with {CATALOG} select gsn, name, abbrev, typ from cat")
def catalog_dedup(spark, d):
    return cat.deduplicated(table(spark, d, "law_catalog_merged"))


@query(f"with {VERS} select * from vers")
def version_seq(spark, d):
    return version_table(spark, d)


@query(f"with {VERS} select abbrev, fassung_vom from vers where seq = 1")
def first_version(spark, d):
    return version_table(spark, d).where("seq = 1").select("abbrev", "fassung_vom")


# --- differences


def _diff(spark, d, **only):
    return diffing.diff_sections(*consecutive(snapshot(spark, d), version_table(spark, d)), ver.VERSION, **only)


@query(f"with {DIFF} select abbrev, fassung_vom, section_id, heading, old_body, new_body, change_kind from diff")
def diff_versions(spark, d):
    """All consecutive versions as delivered."""
    return _diff(spark, d)


@query(f"with {DIFF} select abbrev, fassung_vom, section_id, heading, old_body, new_body, change_kind from diff where section_id = '§_1'")
def diff_one_section(spark, d):
    return _diff(spark, d, section_id="§_1")


@query(f"with {DIFF} select abbrev, fassung_vom, section_id, heading, old_body, new_body, change_kind from diff where old_type = 'Anlage' or new_type = 'Anlage'")
def diff_by_type(spark, d):
    return _diff(spark, d, section_type="Anlage")


@query(f"with {DIFF} select abbrev, fassung_vom, count(*) filter (change_kind <> 'unchanged') as changed_count, count(*) filter (change_kind = 'unchanged') as unchanged_count, count(*) as total_sections from diff group by abbrev, fassung_vom")
def diff_summary(spark, d):
    return diffing.diff_summary(_diff(spark, d), ver.VERSION)


@query(f"""with {DIFF} select abbrev, fassung_vom, cast(to_json(list({{'section_id': section_id, 'heading': heading, 'old_body': old_body, 'new_body': new_body}} order by section_id)) as varchar) as json from diff where change_kind <> 'unchanged' group by abbrev, fassung_vom""")
def diff_json(spark, d):
    return diffing.diff_json(_diff(spark, d), ver.VERSION)


@query(f"""with {DIFF} select abbrev, fassung_vom, string_agg('── ' || heading || ' ──' || case when coalesce(old_body, '') <> '' then chr(10) || '- ' || old_body else '' end || case when coalesce(new_body, '') <> '' then chr(10) || '+ ' || new_body else '' end, chr(10) || chr(10) order by section_id) as text
  from diff where change_kind <> 'unchanged' group by abbrev, fassung_vom""")
def diff_plain_lines(spark, d):
    return diffing.diff_plain_lines(_diff(spark, d), ver.VERSION)


@query(f"""with {DIFF} select abbrev, fassung_vom, count(*) as sections, cast(sum(len(list_filter({para_sql("new_body")}, lambda p: not list_contains({para_sql("old_body")}, p)))) as bigint) as insertions,
  cast(sum(len(list_filter({para_sql("old_body")}, lambda p: not list_contains({para_sql("new_body")}, p)))) as bigint) as deletions from diff where change_kind <> 'unchanged' group by abbrev, fassung_vom""")
def diff_paragraph_stats(spark, d):
    return diffing.paragraph_counts(_diff(spark, d), ver.VERSION)


@query(f"""with {ASOF}, nxt as (select *, lead(fassung_vom) over (partition by abbrev order by seq) as next_date from vers),
 o as (select a.abbrev, next_date as fassung_vom, section_id, heading, body from recon a join nxt on a.abbrev = nxt.abbrev and a.seq = nxt.seq where next_date is not null),
 n as (select abbrev, fassung_vom, section_id, heading, body from recon where seq > 1),
 j as (select coalesce(o.abbrev, n.abbrev) as abbrev, coalesce(o.fassung_vom, n.fassung_vom) as fassung_vom, coalesce(o.section_id, n.section_id) as section_id, coalesce(o.body, '') as ob, coalesce(n.body, '') as nb,
   coalesce(nullif(n.heading, ''), case when coalesce(o.body, '') = coalesce(n.body, '') then null else nullif(o.heading, '') end, '') as h
  from o full outer join n on o.abbrev = n.abbrev and o.fassung_vom = n.fassung_vom and o.section_id = n.section_id)
 select abbrev, fassung_vom, section_id, {display_sql("section_id", "h")} as heading, case when ob <> nb and ob <> '' then {strip_sql("ob")} end as old_body, case when ob <> nb and nb <> '' then {strip_sql("nb")} end as new_body,
  case when ob = nb then 'unchanged' when ob = '' then 'added' when nb = '' then 'removed' else 'changed' end as change_kind from j""")
def diff_asof(spark, d):
    """All consecutive versions as reconstructed, with display headings."""
    full = stored(ver.as_of_all(normalized(spark, d)).withColumn("section_type", F.lit(None).cast("string")))
    return diffing.diff_as_shown(*consecutive(full, full.select(*ver.VERSION, "seq").distinct()), ver.VERSION)


@query(f"with {RULES} select abbrev, fassung_vom, common, proper, common / nullif(proper, 0) as overlap from cnt")
def key_overlap(spark, d):
    """How many proper ids of each version the first version has as well."""
    s = normalized(spark, d)
    proper = ver.is_proper(F.col("section_id"))
    first = s.where("seq = 1").where(proper).select("abbrev", "section_id", F.lit(1).alias("known"))
    out = s.join(first, ["abbrev", "section_id"], "left").groupBy(*ver.VERSION).agg(F.count("known").alias("common"), F.count_if(proper).alias("proper"))
    return out.withColumn("overlap", F.try_divide("common", "proper"))


@query(f"with {ASOF} select abbrev, fassung_vom, section_id, heading, body from recon qualify seq = max(seq) over (partition by abbrev)")
def asof_snapshot(spark, d):
    """The newest version of each law as reconstructed."""
    s = normalized(spark, d)
    return ver.as_of_all(s, s.groupBy("abbrev").agg(F.max("seq").alias("seq"))).select(*ver.VERSION, "section_id", "heading", "body")


@query(f"with {ASOF} select abbrev, fassung_vom, seq, section_id, heading, body, cast(written_seq as integer) as written_seq from recon")
def asof_all_versions(spark, d):
    return ver.as_of_all(normalized(spark, d))


@query(f"with {RULES} select abbrev, fassung_vom, seq, rule, drop_first from rules")
def overlay_baseline(spark, d):
    return ver.overlay_rules(normalized(spark, d))


@query(f"with {CHG} select abbrev, fassung_vom, section_id, change_kind from chg")
def changed_sections(spark, d):
    return ver.changed_sections(normalized(spark, d))


@query(f"with {LISTS} select abbrev, fassung_vom, changed[1:8] as shown, cast(greatest(len(changed) - 8, 0) as integer) as more from lists")
def changed_preview(spark, d):
    """The first eight changed sections of each version, and how many more there are."""
    c = ver.changed_lists(normalized(spark, d))
    return c.select(*ver.VERSION, F.slice("changed", 1, 8).alias("shown"), F.greatest(F.size("changed") - 8, F.lit(0)).alias("more"))


@query(f"""with {ASOF}, {LISTS[LISTS.index("nxt as"):]}, tot as (select * from (select abbrev, fassung_vom, count(*) as sections from recon group by all) qualify fassung_vom = max(fassung_vom) over (partition by abbrev)),
  {FLAG}, {CATALOG}, first as (select gsn, fassung_vom, aenderung from law_versions qualify row_number() over (partition by gsn, fassung_vom order by version_id) = 1)
  select l.abbrev, coalesce({CLEAN.format("cat.name")}, '') as name, coalesce(flag.listed, false) as listed, l.fassung_vom, f.aenderung, t.sections, cast(len(changed) as integer) as changed_count, changed[1:30] as changed_sections from lists l left join tot t using (abbrev, fassung_vom) left join first f on f.gsn = l.abbrev and f.fassung_vom = l.fassung_vom left join cat on cat.gsn = l.abbrev left join flag on flag.gsn = l.abbrev""")
def law_detail(spark, d):
    """Each version, newest first, with its amendment, its changes (30 at most are listed) and, for the newest, all sections."""
    s = normalized(spark, d)
    changed = ver.changed_lists(s)
    totals = ver.as_of_all(s, s.groupBy("abbrev").agg(F.max("seq").alias("seq"))).groupBy(*ver.VERSION).agg(F.count("*").alias("sections"))
    first = ver.group_by_date_first(table(spark, d, "law_versions")).select(F.col("gsn").alias("abbrev"), "fassung_vom", "aenderung")
    out = changed.join(totals, ver.VERSION, "left").join(first, ver.VERSION, "left")
    out = _named(spark, d, out)
    return out.select("abbrev", "name", "listed", "fassung_vom", "aenderung", "sections", F.size("changed").alias("changed_count"), F.slice("changed", 1, 30).alias("changed_sections")).orderBy("abbrev", F.desc("fassung_vom"))


# --- summaries


def _index(spark, d, sections):
    per = sections.groupBy(*ver.VERSION).agg(F.count("*").alias("n"))
    return per.groupBy("abbrev").agg(F.count("*").alias("versions"), F.max_by("n", "fassung_vom").alias("sections"), F.max("fassung_vom").alias("newest_fassung_vom"))


@query(f"""with {VERS}, {CATALOG}, {FLAG}, per as (select abbrev, fassung_vom, count(*) as n from snap group by all)
  select p.abbrev, coalesce({CLEAN.format("max(cat.name)")}, '') as name, count(*) as versions, arg_max(n, fassung_vom) as sections, max(fassung_vom) as newest_fassung_vom, coalesce(bool_or(listed), false) as listed
  from per p left join cat on cat.gsn = p.abbrev left join flag on flag.gsn = p.abbrev group by p.abbrev""")
def law_index(spark, d):
    return _named(spark, d, _index(spark, d, snapshot(spark, d))).select("abbrev", "name", "versions", "sections", "newest_fassung_vom", "listed")


@query(f"with {ASOF}, per as (select abbrev, fassung_vom, count(*) as n from recon group by all) select abbrev, count(*) as versions, arg_max(n, fassung_vom) as sections, max(fassung_vom) as newest_fassung_vom from per group by abbrev")
def law_index_overlay(spark, d):
    return _index(spark, d, ver.as_of_all(normalized(spark, d)))


@query(f"with {VERS}, per as (select abbrev, fassung_vom, count(*) as n from snap group by all), l as (select abbrev, count(*) as versions, arg_max(n, fassung_vom) as sections from per group by abbrev) select count(*) as laws, cast(sum(versions) as bigint) as versions, cast(sum(sections) as bigint) as sections from l")
def header_stats(spark, d):
    return _index(spark, d, snapshot(spark, d)).agg(F.count("*").alias("laws"), F.sum("versions").alias("versions"), F.sum("sections").alias("sections"))


@query(f"with {VERS}, per as (select abbrev, fassung_vom, count(*) as n from snap group by all) select abbrev, max(n) as sections from per group by abbrev")
def max_sections(spark, d):
    return snapshot(spark, d).groupBy(*ver.VERSION).agg(F.count("*").alias("n")).groupBy("abbrev").agg(F.max("n").alias("sections"))


@query("select gsn, name, abbrev, typ from law_catalog_merged where gsn is not null qualify row_number() over (partition by gsn order by cat_id // 100 desc, cat_id) = 1")
def catalog_pages(spark, d):
    """The catalog as a crawl by pages of 100 keeps it."""
    return cat.deduplicated_by_page(table(spark, d, "law_catalog_merged"), F.floor(F.col("cat_id") / 100))


@query("select version_id, left(md5(message), 8) as short_id, case when fassung_vom >= '1970-01-01' and fassung_vom < '2100-01-01' then fassung_vom end as author_date from law_versions")
def version_ids(spark, d):
    """Short ids (of a hash of the message) and author dates of all versions."""
    return table(spark, d, "law_versions").select("version_id", ver.short_id(F.md5(F.col("message").cast("binary"))).alias("short_id"), ver.author_date(F.col("fassung_vom")).alias("author_date"))


@query("select typ, count(*) as records, count(*) filter (nutzdaten is null or nutzdaten = '') as empty, count(distinct gsn) as laws from nor_xml group by typ")
def run_totals(spark, d):
    """Totals of a fetch by type of law."""
    x = table(spark, d, "nor_xml")
    return x.groupBy("typ").agg(F.count("*").alias("records"), F.count_if(F.coalesce(F.col("nutzdaten"), F.lit("")) == "").alias("empty"), F.countDistinct("gsn").alias("laws"))


@query(f"with {CATALOG} select l.gsn, {CLEAN.format('cat.name')} as name from (select distinct gsn from law_versions where gsn is not null) l left join cat using (gsn) where cat.gsn is not null union all select gsn, null from (select distinct gsn from law_versions where gsn is not null) where gsn not in (select gsn from cat)")
def law_names(spark, d):
    return cat.law_names(table(spark, d, "law_versions").where("gsn is not null").select("gsn").distinct(), table(spark, d, "law_catalog_merged"))


@query(f"""with {CATALOG}, l as (select distinct gsn, abbrev from law_versions), a as (select abbrev, name from law_catalog_merged where abbrev <> '' qualify row_number() over (partition by abbrev order by cat_id) = 1)
  select l.gsn, l.abbrev, coalesce(nullif({CLEAN.format("cat.name")}, ''), nullif({CLEAN.format("a.name")}, ''), '') as name from l left join cat on cat.gsn = l.gsn left join a on a.abbrev = l.abbrev""")
def law_names_fallback(spark, d):
    return cat.law_names_fallback(table(spark, d, "law_versions").select("gsn", "abbrev").distinct(), table(spark, d, "law_catalog_merged"))


@query("select gsn, abbrev, abbrev is not null and abbrev in (select index_abbrev from final_gsn_list where index_abbrev is not null) as listed from (select distinct gsn, abbrev from law_versions)")
def synthetic_flag(spark, d):
    """Whether a law's abbreviation is a member of another list."""
    known = table(spark, d, "final_gsn_list").select(F.col("index_abbrev").alias("abbrev"), F.lit(True).alias("listed")).where("abbrev is not null").distinct()
    return table(spark, d, "law_versions").select("gsn", "abbrev").distinct().join(known, "abbrev", "left").select("gsn", "abbrev", F.coalesce("listed", F.lit(False)).alias("listed"))


@query(f"select cat_id, {CLEAN.format('name')} as name from law_catalog_merged")
def clean_law_name(spark, d):
    return table(spark, d, "law_catalog_merged").select("cat_id", t.clean_law_name(F.col("name")).alias("name"))


@query(f"with {CATALOG} select gsn, name, abbrev from cat where contains(lower(coalesce(abbrev, '')), 'schutz') or contains(lower(coalesce(name, '')), 'schutz')")
def law_search(spark, d):
    """Laws whose abbreviation or name has a text in it, case aside."""
    has = lambda c: F.lower(F.coalesce(c, F.lit(""))).contains("schutz")
    return cat.deduplicated(table(spark, d, "law_catalog_merged")).where(has("abbrev") | has("name")).select("gsn", "name", "abbrev")


@query(f"with {VERS}, {CATALOG}, per as (select abbrev, fassung_vom, count(*) as n from snap group by all), l as (select p.abbrev, coalesce({CLEAN.format("max(cat.name)")}, '') as name, count(*) as versions, arg_max(n, fassung_vom) as sections from per p left join cat on cat.gsn = p.abbrev group by p.abbrev) select abbrev, name, versions, sections from l where contains(lower(abbrev || ' ' || name || ' ' || versions || ' ' || sections), 'gesetz 19')")
def card_search(spark, d):
    """Laws whose shown text (abbreviation, name and counts) has a text in it."""
    return law_index(spark, d).where(F.lower(F.concat_ws(" ", "abbrev", "name", "versions", "sections")).contains("gesetz 19")).select("abbrev", "name", "versions", "sections")


@query(f"""with {VERS}, per as (select abbrev, fassung_vom, count(*) as n from snap group by all), l as (select abbrev, count(*) as versions, arg_max(n, fassung_vom) as sections from per group by abbrev)
  select abbrev, cast(row_number() over (order by abbrev) as integer) as by_name, cast(row_number() over (order by versions desc, abbrev) as integer) as by_versions, cast(row_number() over (order by sections desc, abbrev) as integer) as by_sections from l""")
def law_sort_modes(spark, d):
    """The place of each law in three orders; names in German order."""
    rows = _index(spark, d, snapshot(spark, d))
    german = F.collate("abbrev", "de")
    for name, order in (("by_name", (german,)), ("by_versions", (F.desc("versions"), german)), ("by_sections", (F.desc("sections"), german))):
        rows = with_place(rows, name, *order)
    return rows.select("abbrev", "by_name", "by_versions", "by_sections")


@query(f"with {NORM}, last as (select * from norm qualify seq = max(seq) over (partition by abbrev)) select abbrev, section_id, cast(row_number() over (partition by abbrev order by {order_sql()}, section_id) as integer) as place from last")
def section_natural_sort(spark, d):
    """The sections of each law's newest version in natural order."""
    s = newest(normalized(spark, d))
    w = Window.partitionBy("abbrev").orderBy(t.section_sort_key(F.col("section_id")), "section_id")
    return s.select("abbrev", "section_id", F.row_number().over(w).alias("place"))


# --- scalar functions


LEAD = "(?i)^(?:Art(?:ikel)?\\.?\\s*)?§\\.?\\s*(\\d+[a-z]?)"
ART = "(?i)^Art(?:ikel)?\\.?\\s*([IVXLCDM]+|\\d+)"


@query(f"""select rec_id, case when regexp_matches(h, '{LEAD}\\b') then '§_' || regexp_extract(h, '{LEAD}\\b', 1) when regexp_matches(h, '{ART}\\b') then 'Art_' || regexp_extract(h, '{ART}\\b', 1)
  when regexp_matches(h, '(?i)^Anlage\\s+(\\d+[a-z]?)') then 'Anlage_' || regexp_extract(h, '(?i)^Anlage\\s+(\\d+[a-z]?)', 1) when regexp_matches(b, '{LEAD}\\.?\\s') then '§_' || regexp_extract(b, '{LEAD}\\.?\\s', 1)
  when regexp_matches(b, '{ART}') then 'Art_' || regexp_extract(b, '{ART}', 1) else 'Section-' || (cast('0x' || left(md5(b), 8) as bigint) % 10000) end as section_id from (select rec_id, coalesce(heading, '') as h, coalesce(body, '') as b from fassung)""")
def derive_section_id(spark, d):
    x = table(spark, d, "fassung")
    return x.select("rec_id", t.derive_section_id(F.lit(""), F.lit(""), F.col("heading"), F.col("body")).alias("section_id"))


ENTRY = "(?i)^Art(?:ikel)?\\.?\\s*([IVXLCDM\\d]+)"
ENTRY_BOTH = ENTRY + "\\s*§\\.?\\s*(\\d+[a-z]?)"


@query(f"""select xml_id, case when regexp_matches(a, '{ENTRY_BOTH}') then 'Art_' || regexp_extract(a, '{ENTRY_BOTH}', 1) || '_§_' || regexp_extract(a, '{ENTRY_BOTH}', 2) when regexp_matches(a, '{ENTRY}') then 'Art_' || regexp_extract(a, '{ENTRY}', 1)
  when regexp_matches(a, '(?i)^§\\.?\\s*(\\d+[a-z]?)') then '§_' || regexp_extract(a, '(?i)^§\\.?\\s*(\\d+[a-z]?)', 1) when regexp_matches(s, '{LEAD}\\b') then '§_' || regexp_extract(s, '{LEAD}\\b', 1) when regexp_matches(s, '{ART}\\b') then 'Art_' || regexp_extract(s, '{ART}\\b', 1)
  else 'Section-' || (cast('0x' || left(md5(''), 8) as bigint) % 10000) end as section_id from (select xml_id, coalesce(apa, '') as a, coalesce(regexp_extract(nutzdaten, '<gldsym[^>]*>([^<]*)</gldsym>', 1), '') as s from nor_xml)""")
def derive_section_id_entry(spark, d):
    """Ids by the index entry, else by the first symbol in the XML."""
    x = table(spark, d, "nor_xml")
    symbol = F.regexp_extract(F.coalesce("nutzdaten", F.lit("")), "<gldsym[^>]*>([^<]*)</gldsym>", 1)
    return x.select("xml_id", t.derive_section_id(F.col("apa"), symbol, F.lit(""), F.lit("")).alias("section_id"))


@query("""select xml_id, case when contains(a, '§') then 'Paragraf' when regexp_matches(a, '(?i)^Art') then 'Artikel' when contains(a, 'Anlage') then 'Anlage'
  when regexp_matches(h, '(?i)^Art(?:ikel)?\\.?\\s*[IVXLCDM\\d]') then 'Artikel' when starts_with(h, '§') then 'Paragraf' when contains(h, 'Anlage') then 'Anlage' else 'Paragraf' end as section_type from (select xml_id, coalesce(apa, '') as a, coalesce(titel, '') as h from nor_xml)""")
def derive_section_type(spark, d):
    return table(spark, d, "nor_xml").select("xml_id", t.derive_section_type(F.col("apa"), F.col("titel")).alias("section_type"))


@query(f"select rec_id, {n_sql('section_id')} as section_id from fassung")
def norm_section_id(spark, d):
    return table(spark, d, "fassung").select("rec_id", t.norm_section_id(F.col("section_id")).alias("section_id"))


@query(f"select rec_id, {x_sql('body')} as section_id from fassung")
def extract_id_from_body(spark, d):
    return table(spark, d, "fassung").select("rec_id", t.extract_id_from_body(F.col("body")).alias("section_id"))


@query(f"select rec_id, {strip_sql('body')} as body from fassung")
def strip_section_prefix(spark, d):
    return table(spark, d, "fassung").select("rec_id", t.strip_section_prefix(F.col("body")).alias("body"))


@query(f"select rec_id, {display_sql('section_id', 'heading')} as heading from fassung")
def display_heading(spark, d):
    return table(spark, d, "fassung").select("rec_id", t.display_heading(F.col("section_id"), F.col("heading")).alias("heading"))


@query(f"select rec_id, {bad_sql('heading')} as bad from fassung")
def heading_quality(spark, d):
    return table(spark, d, "fassung").select("rec_id", t.heading_is_bad(F.col("heading")).alias("bad"))


@query(f"with {NORM} select abbrev, fassung_vom, seq, section_id, heading, body, section_type, arrival from norm")
def normalize_sections(spark, d):
    return ver.normalize_sections(numbered(spark, d))


@query("select * from (values ('I', 1), ('IV', 4), ('IX', 9), ('XIV', 14), ('XL', 40), ('MCMXC', 1990), ('IIII', 4), ('iv', 4), ('ABC', null), ('', 0)) v(roman, value)")
def roman_to_int(spark, d):
    x = spark.createDataFrame([(r,) for r in ("I", "IV", "IX", "XIV", "XL", "MCMXC", "IIII", "iv", "ABC", "")], "roman string")
    return x.select("roman", t.roman_to_int(F.col("roman")).alias("value"))


@query(f"select cat_id, {NN.format('name')} as name from law_catalog_merged")
def normalize_name(spark, d):
    return table(spark, d, "law_catalog_merged").select("cat_id", t.normalize_name(F.col("name")).alias("name"))


@query(f"""with {LAW}, e as (select entry_id, {NN.format("index_name")} as a from ent), l as (select gsn, {NN.format("name")} as b from law)
  select distinct entry_id, gsn, case when a = b then 1.0 else len(list_intersect(list_distinct(string_split(a, ' ')), list_distinct(string_split(b, ' ')))) / len(list_distinct(list_concat(string_split(a, ' '), string_split(b, ' ')))) end as similarity
  from (select *, unnest(list_distinct(string_split(a, ' ')[1:2])) as w from e where a <> '') e join (select *, string_split(b, ' ')[1] as w from l where b <> '') l using (w)""")
def jaccard_words(spark, d):
    """The common words of every entry and law of one block."""
    return cat.blocked_pairs(*_registers(spark, d)).select("entry_id", "gsn", t.jaccard_words(F.col("a"), F.col("b")).alias("similarity"))


@query("select cat_id, list_max(list_transform(regexp_extract_all(name, '\\b((?:19|20)\\d{2})\\b', 1), lambda y: cast(y as integer))) as year from law_catalog_merged")
def extract_year(spark, d):
    return table(spark, d, "law_catalog_merged").select("cat_id", t.extract_year(F.col("name")).alias("year"))


@query("""select rec_id, case when body_blocks is null then null else array_to_string(list_transform(body_blocks, lambda b: case when b.type = 'list' then array_to_string(list_transform(coalesce(b.items, []), lambda i: case when coalesce(i.symbol, '') <> '' then i.symbol || ' ' || coalesce(i.text, '') else coalesce(i.text, '') end), chr(10)) when b.type = 'text' then coalesce(b.text, '') else '' end), chr(10)) end as body from fassung""")
def render_blocks(spark, d):
    return table(spark, d, "fassung").select("rec_id", t.render_blocks(F.col("body_blocks")).alias("body"))


@query("""with b as (select rec_id, unnest(body_blocks) as b from fassung where body_blocks is not null), i as (select rec_id, unnest(b.items) as i from b where b.items is not null) select rec_id, i.symbol as symbol, i.text as text from i""")
def block_items_explode(spark, d):
    blocks = table(spark, d, "fassung").select("rec_id", F.explode("body_blocks").alias("b"))
    return blocks.select("rec_id", F.explode("b.items").alias("i")).select("rec_id", "i.symbol", "i.text")


@query(f"select rec_id, {para_sql('body')} as paragraphs from fassung")
def paragraph_split(spark, d):
    return table(spark, d, "fassung").select("rec_id", t.paragraphs(F.col("body")).alias("paragraphs"))


@query(f"""with {NORM}, p as (select abbrev, section_id, {para_sql("body")} as p from norm qualify seq = max(seq) over (partition by abbrev)) select abbrev, section_id, cast(u.no as integer) as no, u.text as paragraph from (select abbrev, section_id, unnest(list_transform(range(1, len(p) + 1), lambda i: {{'no': i, 'text': p[i]}})) as u from p)""")
def fulltext_paragraphs(spark, d):
    """The paragraphs of each law's newest version."""
    s = newest(normalized(spark, d)).select("abbrev", "section_id", F.posexplode(t.paragraphs(F.col("body"))).alias("no", "paragraph"))
    return s.withColumn("no", F.col("no") + 1)


@query("select rec_id, regexp_extract_all(body, '\\s+|\\S+', 0) as tokens from fassung where body is not null")
def word_tokens(spark, d):
    return table(spark, d, "fassung").where("body is not null").select("rec_id", t.word_tokens(F.col("body")).alias("tokens"))


# --- catalogs


def _registers(spark, d):
    return table(spark, d, "final_gsn_list"), table(spark, d, "law_catalog_merged")


@query(f"with {LAW} select entry_id, gsn, cast(1.0 as double) as score from ent join law on lower(index_abbrev) = lower(abbrev) where index_abbrev <> ''")
def match_exact(spark, d):
    return cat.match_exact(*_registers(spark, d))


@query(f"with {LAW} select entry_id, gsn, cast(0.95 as double) as score from ent join law on {NN.format('index_abbrev')} = {NN.format('abbrev')} where {NN.format('index_abbrev')} <> ''")
def match_normalized(spark, d):
    return cat.match_normalized(*_registers(spark, d))


@query(f"with {LAW}, e as (select entry_id, {NN.format('index_abbrev')} as a from ent), l as (select gsn, {NN.format('abbrev')} as b from law) select entry_id, gsn, cast(0.85 as double) as score from e, l where a <> '' and b <> '' and (contains(a, b) or contains(b, a))")
def match_containment(spark, d):
    return cat.match_containment(*_registers(spark, d))


WORDS = f"""{LAW}, e as (select entry_id, {NN.format("index_name")} as a from ent), l as (select gsn, {NN.format("name")} as b from law),
 p as (select distinct entry_id, gsn, a, b from (select *, unnest(list_distinct(string_split(a, ' ')[1:2])) as w from e where a <> '') e join (select *, string_split(b, ' ')[1] as w from l where b <> '') l using (w)),
 s as (select *, case when a = b then 1.0 else len(list_intersect(list_distinct(string_split(a, ' ')), list_distinct(string_split(b, ' ')))) / len(list_distinct(list_concat(string_split(a, ' '), string_split(b, ' ')))) end as score from p),
 m as (select entry_id, gsn, score from (select *, max(score) over (partition by entry_id) as top from s where score >= 0.2) where score >= top - 0.02)"""


@query(f"with {WORDS} select entry_id, gsn, score from m")
def match_words(spark, d):
    return cat.match_words(*_registers(spark, d))


@query()
def match_blocked_fuzzy(spark, d):
    return cat.match_blocked_fuzzy(*_registers(spark, d))


@query()
def match_cascade(spark, d):
    return cat.match_cascade(*_registers(spark, d))


YEAR = "list_max(list_transform(regexp_extract_all({0}, '\\b((?:19|20)\\d{{2}})\\b', 1), lambda y: cast(y as integer)))"
RESOLVED = f"""{WORDS}, j as (select m.entry_id, m.gsn, m.score, index_name, index_abbrev, name, abbrev, lower(abbrev) = lower(index_abbrev) as exact, coalesce({YEAR.format("index_name")}, {YEAR.format("index_abbrev")}) as y from m join ent using (entry_id) join law using (gsn)),
 k as (select *, sum(cast(exact as integer)) over (partition by entry_id) = 1 as one from j),
 r as (select *, case when one and exact then 3 when not one and coalesce({YEAR.format("name")} = y, false) then 2 else 1 end as rank from k),
 resolved as (select entry_id, gsn, score, case rank when 3 then 'abbrev' when 2 then 'year' else 'newest' end as rule from r qualify row_number() over (partition by entry_id order by rank desc, gsn desc) = 1)"""


@query(f"with {RESOLVED} select entry_id, gsn, score, rule from resolved")
def disambiguate(spark, d):
    e, c = _registers(spark, d)
    return cat.disambiguate(cat.match_words(e, c), e, c)


FINAL = f"""{RESOLVED}, best as (select gsn, entry_id, score from resolved qualify row_number() over (partition by gsn order by score desc, entry_id) = 1),
 final as (select gsn, index_name, index_abbrev, name as catalog_name, typ as catalog_typ, score from best join ent using (entry_id) join law using (gsn))"""


@query(f"with {FINAL} select * from final")
def final_list(spark, d):
    e, c = _registers(spark, d)
    return cat.final_list(cat.disambiguate(cat.match_words(e, c), e, c), e, c)


@query(f"with {FINAL} select catalog_typ, count(*) as laws from final group by catalog_typ")
def count_by_type(spark, d):
    return final_list(spark, d).groupBy("catalog_typ").agg(F.count("*").alias("laws"))


# The three above have SQL, which can't express the cascade's ratio of matching characters, so they start from common
# words. Those below are the whole of it: every step of the cascade, then the same rules.


@query()
def disambiguate_cascade(spark, d):
    e, c = _registers(spark, d)
    return cat.disambiguate(cat.match_cascade(e, c), e, c)


@query()
def final_list_cascade(spark, d):
    e, c = _registers(spark, d)
    return cat.final_list(cat.disambiguate(cat.match_cascade(e, c), e, c), e, c)


@query()
def count_by_type_cascade(spark, d):
    return final_list_cascade(spark, d).groupBy("catalog_typ").agg(F.count("*").alias("laws"))


# --- sequences and XML


@query()
def paragraph_diff(spark, d):
    """The edit script of paragraphs of every changed section of consecutive versions."""
    c = _diff(spark, d).where("change_kind = 'changed'")
    return c.select(*ver.VERSION, "section_id", seq.paragraph_diff(t.paragraphs(F.col("old_body")), t.paragraphs(F.col("new_body"))).alias("script"))


@query()
def word_diff(spark, d):
    """The edit script of words of every modified paragraph."""
    m = paragraph_diff(spark, d).select(*ver.VERSION, "section_id", F.posexplode("script").alias("no", "s")).where("s.op = 'modified'")
    return m.select(*ver.VERSION, "section_id", "no", seq.word_diff(t.word_tokens(F.col("s.old")), t.word_tokens(F.col("s.new"))).alias("script"))


@query()
def xml_parse(spark, d):
    return parse_sections(table(spark, d, "nor_xml"))


INDEX = "idx as (select gsn as abbrev, fassung_vom, nor_id, rec_id from fassung where nor_id is not null), doc as (select nor_id, nutzdaten from nor_xml where nor_id is not null qualify row_number() over (partition by nor_id order by abgerufen_am desc nulls last, xml_id desc) = 1)"


def _index_rows(spark, d):
    return table(spark, d, "fassung").select(F.col("gsn").alias("abbrev"), "fassung_vom", "nor_id", F.col("rec_id").alias("arrival"))


@query()
def xml_outcomes(spark, d):
    """What came of parsing each record."""
    return outcomes(table(spark, d, "nor_xml"))


@query()
def build_fassung_xml(spark, d):
    """The sections of every version from the documents its index names: the newest fetch of each, empty ones skipped, the longest body of an id."""
    parsed = sections_of_index(_index_rows(spark, d), table(spark, d, "nor_xml")).where("outcome = 'section'")
    return ver.build_snapshot(parsed.drop("body_blocks"))


@query(f"with {INDEX} select abbrev, fassung_vom, count(*) as documents, count(*) filter (doc.nor_id is null) as not_fetched, count(*) filter (doc.nor_id is not null and coalesce(nutzdaten, '') = '') as without_text from idx left join doc using (nor_id) group by abbrev, fassung_vom")
def build_fassung_totals(spark, d):
    """The documents of each version, those never fetched, and those fetched without text."""
    parsed = sections_of_index(_index_rows(spark, d), table(spark, d, "nor_xml"))
    empty = stored(table(spark, d, "nor_xml").where("nor_id is not null").groupBy("nor_id").agg(F.max_by(F.coalesce("nutzdaten", F.lit("")), F.struct("abgerufen_am", "xml_id")).alias("x")).where("x = ''").select("nor_id", F.lit(True).alias("blank")))
    rows = parsed.join(empty, "nor_id", "left")
    return rows.groupBy("abbrev", "fassung_vom").agg(F.count("*").alias("documents"), F.count_if(F.col("outcome") == "not fetched").alias("not_fetched"), F.count_if("blank").alias("without_text"))


@query(f"with {INDEX} select count(distinct abbrev) as laws, count(distinct (abbrev, fassung_vom)) as versions, count(*) as documents, count(*) filter (doc.nor_id is null) as not_fetched from idx left join doc using (nor_id)")
def run_summary(spark, d):
    """The totals of a run over all laws: laws, versions, documents named, documents never fetched."""
    parsed = sections_of_index(_index_rows(spark, d), table(spark, d, "nor_xml"))
    per = parsed.groupBy("abbrev", "fassung_vom").agg(F.count("*").alias("documents"), F.count_if(F.col("outcome") == "not fetched").alias("not_fetched"))
    return per.agg(F.countDistinct("abbrev").alias("laws"), F.count("*").alias("versions"), F.sum("documents").alias("documents"), F.sum("not_fetched").alias("not_fetched"))


@query("select gsn, count(*) as commits, count(distinct fassung_vom) as dates from law_versions group by gsn")
def version_counts(spark, d):
    """How many versions of each law were committed, and of how many dates."""
    return table(spark, d, "law_versions").groupBy("gsn").agg(F.count("*").alias("commits"), F.countDistinct("fassung_vom").alias("dates"))


@query()
def build_fassung_errors(spark, d):
    """The documents of each version that gave no section, with the reason."""
    parsed = sections_of_index(_index_rows(spark, d), table(spark, d, "nor_xml"))
    return parsed.where("outcome != 'section'").select("abbrev", "fassung_vom", "nor_id", "outcome").distinct()


@query()
def xml_unknown_tags(spark, d):
    return unknown_tags(table(spark, d, "nor_xml"))


# --- quality


QS = "q as (select gsn as abbrev, fassung_vom, section_id, body, rec_id as arrival from fassung)"
GAPS = """g as (select abbrev, fassung_vom, from_no, to_no from (select *, lead(from_no) over (partition by abbrev, fassung_vom order by from_no) as to_no, count(*) over (partition by abbrev, fassung_vom) as n
  from (select abbrev, fassung_vom, cast(regexp_extract(section_id, '^§_(\\d+)[a-z]?$', 1) as integer) as from_no from q where regexp_matches(section_id, '^§_\\d+[a-z]?$'))) where n >= 5 and to_no - from_no > 5)"""
DUP = "dup as (select abbrev, fassung_vom, section_id, count(*) as n from q group by all having count(*) > 1)"
ORDER = """pl as (select abbrev, fassung_vom, section_id, row_number() over (partition by abbrev, fassung_vom order by arrival) as at, row_number() over (partition by abbrev, fassung_vom order by k, n, s, arrival) as due from (
   select *, case when num is not null then 0 when contains(section_id, '_') then 1 else 2 end as k, coalesce(num, 0) as n, case when num is not null then string_split(section_id, '_')[1] else section_id end as s from (
   select *, case when regexp_matches(section_id, '^[^_]*_\\d+$') then cast(regexp_extract(section_id, '_(\\d+)$', 1) as integer) end as num from q))),
 ooo as (select a.abbrev, a.fassung_vom, count(*) as n_out_of_order from pl a join pl b on a.abbrev = b.abbrev and a.fassung_vom = b.fassung_vom and a.at = b.due where a.section_id <> b.section_id group by all)"""
MAL = "case when not (starts_with(section_id, 'Section-') or section_id = 'Text') then case when regexp_matches(section_id, '[,;]$') then 'trailing punctuation' when regexp_matches(section_id, '[._]Paragraph') then 'contains Paragraph text' when regexp_matches(section_id, '\\.\\s') then 'contains spaces/dots' end end"
LEN = "length(trim(coalesce(body, ''), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)))"
SHORT = f"case when {LEN} = 0 then 'empty' when {LEN} < 20 then cast({LEN} as varchar) || ' chars' end"
ISSUES = f"""{QS}, {GAPS}, {DUP}, {ORDER}, c as (select abbrev, fassung_vom, count(*) as total, count(*) filter (starts_with(section_id, 'Section-')) as hashed, count(*) filter (section_id = 'Text') as texts, count({SHORT}) as short, count({MAL}) as malformed from q group by all),
 issues as (select abbrev, fassung_vom, case when hashed > 0.1 * total then 'CRITICAL' else 'WARNING' end as severity, 'section_n' as "check", hashed as n from c where hashed > 0
  union all select abbrev, fassung_vom, 'WARNING', 'text_ids', texts from c where texts > 0 union all select abbrev, fassung_vom, 'WARNING', 'short_bodies', short from c where short > 0
  union all select abbrev, fassung_vom, 'INFO', 'malformed_ids', malformed from c where malformed > 0 union all select abbrev, fassung_vom, 'CRITICAL', 'too_few_sections', total from c where total < 5
  union all select abbrev, fassung_vom, 'INFO', 'gaps', count(*) from g group by all union all select abbrev, fassung_vom, 'CRITICAL', 'duplicates', count(*) from dup group by all
  union all select abbrev, fassung_vom, 'WARNING', 'sort_order', n_out_of_order from ooo)"""
SEV = f"{ISSUES}, sev as (select abbrev, case max(case severity when 'CRITICAL' then 3 when 'WARNING' then 2 else 1 end) when 3 then 'CRITICAL' when 2 then 'WARNING' else 'INFO' end as severity from issues group by abbrev)"


@query(f"with {QS}, {DUP} select * from dup")
def qa_duplicates(spark, d):
    return quality.duplicates(section_rows(spark, d))


@query(f"with {QS}, {GAPS} select * from g")
def qa_gaps(spark, d):
    return quality.gaps(section_rows(spark, d))


@query(f"with {QS}, {GAPS.replace('to_no - from_no > 5', 'to_no - from_no > 1')} select * from g")
def qa_gaps_any(spark, d):
    """The same for any number left out."""
    return quality.gaps(section_rows(spark, d), widest=1)


@query(f"with {QS}, {ORDER} select * from ooo")
def qa_sort_order(spark, d):
    return quality.out_of_order(section_rows(spark, d))


@query(f"select rec_id, {MAL} as problem from fassung where {MAL} is not null")
def qa_malformed_ids(spark, d):
    return table(spark, d, "fassung").select("rec_id", quality.malformed(F.col("section_id")).alias("problem")).where("problem is not null")


@query(f"select rec_id, {SHORT} as problem from fassung where {SHORT} is not null")
def qa_short_bodies(spark, d):
    return table(spark, d, "fassung").select("rec_id", quality.short_body(F.col("body")).alias("problem")).where("problem is not null")


@query("select rec_id, coalesce(length(trim(section_id)) >= 2 and regexp_matches(section_id, '[a-zA-Z0-9]'), false) as valid from fassung")
def qa_valid_ids(spark, d):
    return table(spark, d, "fassung").select("rec_id", quality.valid_id(F.col("section_id")).alias("valid"))


@query("select gsn, n_commits, n_undated, n_commits > 1 and n_undated > 0.1 * n_commits as flagged from (select gsn, count(*) as n_commits, count(*) filter (not coalesce(regexp_matches(message, '\\[\\d{4}-\\d{2}-\\d{2}\\]'), false)) as n_undated from law_versions group by gsn)")
def qa_commit_dates(spark, d):
    return quality.undated(table(spark, d, "law_versions"))


@query(f'with {ISSUES} select abbrev, fassung_vom, severity, "check", n from issues')
def qa_report(spark, d):
    return quality.issues(section_rows(spark, d))


DETAILS = f"""{QS}, {GAPS}, {ORDER},
 lines as (select abbrev, fassung_vom, 'short_bodies' as "check", 5 as most, arrival as o, section_id || ': ' || {SHORT} as t from q where {SHORT} is not null
  union all select abbrev, fassung_vom, 'malformed_ids', 5, arrival, section_id || ': ' || {MAL} from q where {MAL} is not null
  union all select abbrev, fassung_vom, 'gaps', 5, from_no, '§ ' || from_no || ' → § ' || to_no || ' (gap of ' || (to_no - from_no) || ')' from g
  union all select abbrev, fassung_vom, 'duplicates', 5, min(arrival), section_id from q group by abbrev, fassung_vom, section_id having count(*) > 1
  union all select a.abbrev, a.fassung_vom, 'sort_order', 3, a.at, 'pos ' || (a.at - 1) || ': ' || a.section_id || ' should be ' || b.section_id from pl a join pl b on a.abbrev = b.abbrev and a.fassung_vom = b.fassung_vom and a.at = b.due where a.section_id <> b.section_id)"""


@query(f"""with {DETAILS} select abbrev, fassung_vom, "check", count(*) as n, list(t order by o, t)[1:max(most)] as listed from lines group by abbrev, fassung_vom, "check" """)
def qa_details(spark, d):
    """What breaks the rules of each version, the first few in words."""
    return quality.details(section_rows(spark, d))


ENDS = f"""{SNAP}, span as (select abbrev, min(fassung_vom) as a, max(fassung_vom) as b, count(distinct fassung_vom) as versions from snap group by abbrev),
 o as (select s.* from snap s join span on s.abbrev = span.abbrev and s.fassung_vom = a and a <> b), n as (select s.* from snap s join span on s.abbrev = span.abbrev and s.fassung_vom = b and a <> b),
 ends as (select coalesce(o.abbrev, n.abbrev) as abbrev, coalesce(o.section_id, n.section_id) as section_id, coalesce(o.body, '') as ob, coalesce(n.body, '') as nb from o full outer join n on o.abbrev = n.abbrev and o.section_id = n.section_id)"""
LAWS = f"""{ENDS}, per as (select gsn as abbrev, fassung_vom, count(*) as n, count(*) filter ({LEN} > 0) as filled from fassung where gsn is not null and fassung_vom is not null group by all),
 laws as (select abbrev, count(*) as versions from per group by abbrev), com as (select gsn as abbrev, min(fassung_vom) as a, max(fassung_vom) as b, count(*) as m, count(*) filter (not coalesce(regexp_matches(message, '\\[\\d{{4}}-\\d{{2}}-\\d{{2}}\\]'), false)) as bad from law_versions where gsn is not null group by gsn),
 spot as (select * from (select *, row_number() over (partition by abbrev order by section_id) as k from ends where ob <> nb) where k <= 3),
 law_issues as (
  select abbrev, 'CRITICAL' as severity, 'api_error' as "check", 1 as n from com where abbrev not in (select abbrev from laws)
  union all select abbrev, 'CRITICAL', 'git_error', 1 from laws where abbrev not in (select abbrev from com)
  union all select c.abbrev, 'CRITICAL', 'missing_fassung', 1 from com c join laws using (abbrev) left join per p on p.abbrev = c.abbrev and p.fassung_vom = c.b where p.n is null
  union all select c.abbrev, 'CRITICAL', 'empty_fassung', 1 from com c join per p on p.abbrev = c.abbrev and p.fassung_vom = c.b where p.filled = 0
  union all select c.abbrev, 'CRITICAL', 'StF_empty', 1 from com c join laws using (abbrev) left join per p on p.abbrev = c.abbrev and p.fassung_vom = c.a where p.n is null
  union all select c.abbrev, 'CRITICAL', 'latest_empty', 1 from com c join laws using (abbrev) left join per p on p.abbrev = c.abbrev and p.fassung_vom = c.b where p.n is null and c.a <> c.b
  union all select abbrev, 'WARNING', 'commit_messages', bad from com where m > 1 and bad > 0.1 * m
  union all select abbrev, 'WARNING', 'empty_diff', 1 from laws where versions > 1 and abbrev not in (select abbrev from ends)
  union all select abbrev, 'WARNING', 'diff_empty_body', count(*) from spot where ob = '' and nb = '' group by abbrev
  union all select abbrev, 'WARNING', 'diff_section_n', count(*) from spot where starts_with(section_id, 'Section-') group by abbrev)"""


def _first_to_last(spark, d):
    """The difference between each law's first and last version."""
    s = snapshot(spark, d)
    ends = version_table(spark, d).groupBy("abbrev").agg(F.min("fassung_vom").alias("first"), F.max("fassung_vom").alias("last")).where("first != last")
    side = lambda which: s.join(ends.select("abbrev", F.col(which).alias("fassung_vom")), ver.VERSION, "left_semi")
    return diffing.diff_sections(side("first"), side("last"), ["abbrev"])


@query(f'with {LAWS} select abbrev, severity, "check", cast(n as bigint) as n from law_issues')
def qa_law_issues(spark, d):
    """Rules on a law as a whole: its commits, its first and last version, the difference between these."""
    return quality.law_issues(section_rows(spark, d), table(spark, d, "law_versions"), _first_to_last(spark, d))


@query(f"with {SEV} select coalesce(severity, 'OK') as severity, count(*) as n_laws from (select distinct gsn as abbrev from fassung where gsn is not null) left join sev using (abbrev) group by 1")
def qa_histogram(spark, d):
    """How many laws have each worst severity."""
    rows = section_rows(spark, d)
    return quality.histogram(quality.issues(rows), rows.where("abbrev is not null"))


@query(f"with {SEV} select * from sev")
def qa_severity(spark, d):
    return quality.severities(quality.issues(section_rows(spark, d)))


@query(f"""with {SEV} select "check", count(distinct abbrev) as n_laws from issues where severity = 'WARNING' and abbrev in (select abbrev from sev where severity = 'WARNING') group by "check" """)
def qa_warning_categories(spark, d):
    return quality.warning_categories(quality.issues(section_rows(spark, d)))


KINDS = """kinds as (select *, 100 * proper / total as percent_proper, cast(paragraphs > 0 as integer) + cast(articles > 0 as integer) + cast(annexes > 0 as integer) > 1 as mixed from (select abbrev, fassung_vom, count(*) as total, count(*) filter (not starts_with(section_id, 'Section-')) as proper, count(*) filter (starts_with(section_id, 'Section-')) as hashed,
  count(*) filter (starts_with(section_id, '§_')) as paragraphs, count(*) filter (starts_with(section_id, 'Art_')) as articles, count(*) filter (starts_with(section_id, 'Anlage_')) as annexes from q group by all))"""
FIRST = """placed as (select abbrev, fassung_vom, prefix, section_id, row_number() over (partition by abbrev, fassung_vom, prefix order by arrival) as position, row_number() over (partition by abbrev, fassung_vom, prefix order by n, s, arrival) as due from (
  select *, regexp_extract(section_id, '^(§|Art|Anlage)_', 1) as prefix, case when regexp_matches(section_id, '^(?:§|Art|Anlage)_\\d+') then cast(regexp_extract(section_id, '^(?:§|Art|Anlage)_(\\d+)', 1) as integer) else 999999 end as n,
  case when regexp_matches(section_id, '^(?:§|Art|Anlage)_\\d+') then regexp_extract(section_id, '^(?:§|Art|Anlage)_\\d+([a-z]?)', 1) else section_id end as s from q) where prefix <> ''),
 viol as (select a.abbrev, a.fassung_vom, a.prefix, cast(a.position as integer) as position, b.section_id as expected, a.section_id as actual, 'reorder' as kind from placed a join placed b on a.abbrev = b.abbrev and a.fassung_vom = b.fassung_vom and a.prefix = b.prefix and a.position = b.due
  where a.section_id <> b.section_id qualify row_number() over (partition by a.abbrev, a.fassung_vom, a.prefix order by a.position) = 1)"""


@query(f"with {QS}, {KINDS} select abbrev, fassung_vom, total, proper, hashed, paragraphs, articles, annexes, percent_proper, mixed from kinds")
def verify_counts(spark, d):
    return quality.kind_counts(section_rows(spark, d))


@query(f"with {QS}, {FIRST} select * from viol")
def verify_ordering(spark, d):
    return quality.first_violations(section_rows(spark, d))


@query(f"with {QS}, {KINDS}, {FIRST} select count(*) as versions, count(*) filter (hashed > 0) as with_hashed_ids, count(*) filter (percent_proper < 50) as mostly_hashed, count(*) filter (mixed) as mixed, (select count(*) from (select distinct abbrev, fassung_vom from viol)) as out_of_order from kinds")
def verify_report(spark, d):
    rows = section_rows(spark, d)
    kinds = quality.kind_counts(rows).agg(F.count("*").alias("versions"), F.count_if(F.col("hashed") > 0).alias("with_hashed_ids"), F.count_if(F.col("percent_proper") < 50).alias("mostly_hashed"), F.count_if("mixed").alias("mixed"))
    wrong = quality.first_violations(rows).select(*quality.BY).distinct().agg(F.count("*").alias("out_of_order"))
    return kinds.withColumn("_k", F.lit(1)).join(wrong.withColumn("_k", F.lit(1)), "_k").drop("_k")


# --- histories and changes of snapshots as delivered


@query(f"""with {VERS}, nxt as (select *, lead(fassung_vom) over (partition by abbrev order by seq) as next_date from vers),
 r as (select s.abbrev, section_id, body, v.seq, fassung_vom, next_date, case when lag(body) over w = body and lag(v.seq) over w = v.seq - 1 then 0 else 1 end as fresh from snap s join nxt v using (abbrev, fassung_vom) window w as (partition by s.abbrev, section_id order by v.seq)),
 g as (select *, sum(fresh) over (partition by abbrev, section_id order by seq) as run from r)
 select abbrev, section_id, md5(body) as body_md5, min(fassung_vom) as valid_from, coalesce(arg_max(coalesce(next_date, '9999-12-31'), seq), '9999-12-31') as valid_to from g group by abbrev, section_id, run, body""")
def delta_validity(spark, d):
    """The wordings of every section as delivered and their periods, from checkpoints and patches."""
    rows = snapshot(spark, d).withColumn("body_md5", F.md5(F.col("body").cast("binary")))
    return DeltaStore.build(rows, "abbrev", "section_id", "body_md5", "fassung_vom").validity()


@query(f"with {DIFF} select abbrev, fassung_vom, section_id, case when old_body is null then 'added' when new_body is null then 'removed' else 'changed' end as change_kind from diff where old_body is distinct from new_body")
def merkle_changes(spark, d):
    """What changed between consecutive versions as delivered, by digests of hash ranges."""
    return changes(snapshot(spark, d), "abbrev", "fassung_vom", "section_id", "body")
