"""The registered queries over the driver tables, each with its checking SQL.

A query takes the session and the folder of the tables and works on whole
tables. Queries that need files write them under the session's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.functions import (
    array_literal,
    band,
    date_parts,
    drop_list_marks,
    empty_to_null,
    keep_printable_ascii,
    lenient_boolean,
    lenient_double,
    lenient_int,
    list_elements,
    list_kind,
    strict_number,
    trim_wide,
)
from refrain.functions.bands import band_number
from refrain.functions.text import WIDE_SPACE
from refrain.operators.joins import salted_join
from refrain.operators.prepare import (
    classify_items,
    entity_ids,
    minimum_number,
    prepare_items,
    prune_entities,
    rejected_items,
    required_text,
    usable_list,
    with_band,
)
from refrain.operators.quality import rejects_by_reason
from refrain.operators.ranking import top_per_group
from refrain.operators.typed import typed_projection
from refrain.operators.unnest import unnest_list
from refrain.plans import jobs, oracle, views
from refrain.plans.driver_tables import (
    HOT_ITEMS,
    RAW_ITEMS,
    RAW_ITEMS_SQL,
    raw_entities,
    raw_items,
    table,
    typed_entities,
    typed_items,
)
from refrain.session import SESSION_DEFAULTS, scratch_path
from refrain.sinks import load_table, publish_all, write_csv
from refrain.sources import current, read_prepared, read_raw
from refrain.streaming import prepare_stream, read_batches, stream_raw_csv, write_prepared_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query and its SQL, under ``name`` where the function's is taken."""

    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        ORACLE_SQL[name or fn.__name__] = sql
        return fn

    return register


# --- the three views --------------------------------------------------------


def _summary_sql(members: str) -> str:
    return f"""WITH {members}
    SELECT m.id AS track_id, m.name, m.popularity, m.energy,
        m.danceability_level AS danceability,
        CAST(coalesce(sum(e.followers), 0) AS BIGINT) AS artist_followers
    FROM outer_members m LEFT JOIN entities e ON e.id = m.member
    GROUP BY m.id, m.name, m.popularity, m.energy, m.danceability_level"""


def _pairs_sql(members: str) -> str:
    return f"""WITH {members}
    SELECT e.id AS artist_id, e.name AS artist_name, m.id AS track_id, m.name AS track_name
    FROM inner_members m JOIN entities e ON e.id = m.member
    WHERE coalesce(e.followers, 0) > 0"""


@query(_summary_sql(oracle.MEMBERS))
def item_entity_sum(spark, sf_dir):
    return views.track_summary(typed_items(spark, sf_dir), typed_entities(spark, sf_dir))


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}

# A task sorts its partition, and groups it by whole items, in some ten times the
# memory of what it reads, which is compressed.
SMALL_PARTS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB"}


@contextmanager
def _settings(spark, settings: dict[str, str]):
    """Other settings meanwhile, which are put back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _run_with(spark, settings: dict[str, str], make) -> DataFrame:
    """The rows of ``make()``, worked out under other settings, which are put back."""
    path = scratch_path(spark, "worked-out")
    with _settings(spark, settings):
        make().write.parquet(path)
    return spark.read.parquet(path)


def _write_raw(raw: DataFrame, path: str) -> str:
    """Raw rows as CSV; returns the folder.

    All fields of an item make one generated method too large for the JVM to compile,
    so it is split, whatever session this is.
    """
    with _settings(raw.sparkSession, {METHOD_LIMIT: SESSION_DEFAULTS[METHOD_LIMIT]}):
        return write_csv(raw, path)


def _raw_csv(spark, sf_dir, base: str) -> list[str]:
    """Raw items and raw entities as CSV; returns their paths."""
    raw = [f"{base}/raw-items", f"{base}/raw-entities"]
    _write_raw(raw_items(spark, sf_dir), raw[0])
    _write_raw(raw_entities(spark, sf_dir), raw[1])
    return raw


@query(_summary_sql(oracle.HOT_MEMBERS))
def hot_entity_sum(spark, sf_dir):
    """A third of the items belong to one entity, and nothing is broadcast."""
    items, entities = typed_items(spark, sf_dir, HOT_ITEMS), typed_entities(spark, sf_dir)
    hot = views.hot_members(items)
    return _run_with(spark, NO_BROADCAST | SMALL_PARTS, lambda: views.track_summary(items, entities, hot))


@query(_pairs_sql(oracle.HOT_MEMBERS))
def hot_entity_pairs(spark, sf_dir):
    items, entities = typed_items(spark, sf_dir, HOT_ITEMS), typed_entities(spark, sf_dir)
    hot = views.hot_members(items)
    return _run_with(spark, NO_BROADCAST | SMALL_PARTS, lambda: views.artist_track_summary(items, entities, hot))


@query(
    f"""WITH {oracle.HOT_MEMBERS} SELECT id, member FROM inner_members
    WHERE member IN (SELECT id FROM entities WHERE followers > 0)"""
)
def hot_entity_semi(spark, sf_dir):
    items = typed_items(spark, sf_dir, HOT_ITEMS).select("id", "id_artists")
    members = unnest_list(items, "id_artists", "member")
    wanted = typed_entities(spark, sf_dir).filter("followers > 0").select(F.col("id").alias("member"))
    hot = views.hot_members(items)
    return _run_with(
        spark, NO_BROADCAST | SMALL_PARTS,
        lambda: salted_join(members, wanted, "member", "left_semi", hot=hot).select("id", "member"),
    )


def _orders_as_items(spark, sf_dir, energy="o_totalprice"):
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(year(o_orderdate) AS int) AS release_year",
        "concat(o_orderkey) AS id",
        "o_orderpriority AS name",
        f"{energy} AS energy",
    )


def _top_sql(energy="o_totalprice", k=1, columns="release_year, track_id, name, energy"):
    return f"""SELECT {columns} FROM (
        SELECT CAST(year(o_orderdate) AS INTEGER) AS release_year,
            concat(o_orderkey) AS track_id, o_orderpriority AS name, {energy} AS energy,
            CAST(row_number() OVER (
                PARTITION BY year(o_orderdate)
                ORDER BY {energy} DESC NULLS FIRST, concat(o_orderkey)
            ) AS INTEGER) AS place
        FROM orders) WHERE place <= {k}"""


@query(_top_sql())
def top_item_per_year(spark, sf_dir):
    return views.most_energising_track_per_year(_orders_as_items(spark, sf_dir))


_GAPPY = "CASE WHEN o_orderstatus = 'P' AND year(o_orderdate) < 1998 THEN NULL ELSE o_totalprice END"


@query(_top_sql(_GAPPY))
def top_item_null_first(spark, sf_dir):
    return views.most_energising_track_per_year(_orders_as_items(spark, sf_dir, _GAPPY))


@query(_top_sql(k=5, columns="release_year, track_id, energy, place"))
def top_items_per_year(spark, sf_dir):
    items = _orders_as_items(spark, sf_dir).withColumnRenamed("id", "track_id")
    ranked = top_per_group(items, "release_year", "energy", ["track_id"], 5, "place")
    return ranked.drop("name")


@query(_top_sql(k=2000, columns="release_year, track_id, energy, place"))
def top_many_per_year(spark, sf_dir):
    items = _orders_as_items(spark, sf_dir).withColumnRenamed("id", "track_id")
    ranked = top_per_group(items, "release_year", "energy", ["track_id"], 2000, "place")
    return ranked.drop("name")


@query(_top_sql())
def top_item_unlimited_groups(spark, sf_dir):
    """With Spark's own group limit switched off."""
    settings = {"spark.sql.optimizer.windowGroupLimitThreshold": "-1"}
    items = _orders_as_items(spark, sf_dir)
    return _run_with(spark, settings, lambda: views.most_energising_track_per_year(items))


@query(_pairs_sql(oracle.MEMBERS))
def entity_item_pairs_unnest(spark, sf_dir):
    return views.artist_track_summary(
        typed_items(spark, sf_dir), typed_entities(spark, sf_dir)
    )


@query(_pairs_sql(oracle.MEMBERS))
def named_view_pairs(spark, sf_dir):
    views.create_views(spark, typed_items(spark, sf_dir), typed_entities(spark, sf_dir))
    return spark.sql(f"SELECT * FROM {views.PAIRS_VIEW}")


# --- joins, unnesting and aggregates ------------------------------------------


@query(
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE coalesce(c_acctbal, 0) > 0"""
)
def entity_item_pairs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"
    )
    customers = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    pairs = salted_join(orders, customers.select("c_custkey", "c_name"), "c_custkey")
    return pairs.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query(f"WITH {oracle.MEMBERS} SELECT id, member FROM outer_members")
def unnest_outer(spark, sf_dir):
    items = typed_items(spark, sf_dir).select("id", "id_artists")
    return unnest_list(items, "id_artists", "member", outer=True)


@query(f"WITH {oracle.MEMBERS} SELECT id, member FROM inner_members")
def unnest_inner(spark, sf_dir):
    items = typed_items(spark, sf_dir).select("id", "id_artists")
    return unnest_list(items, "id_artists", "member")


@query(
    f"""WITH {oracle.MEMBERS},
    audience AS (
        SELECT id AS member, CAST(sum(followers) AS BIGINT) AS followers
        FROM entities GROUP BY id
    )
    SELECT m.id, m.member, a.followers
    FROM outer_members m LEFT JOIN audience a ON a.member = m.member"""
)
def member_followers(spark, sf_dir):
    audience = (
        typed_entities(spark, sf_dir)
        .groupBy(F.col("id").alias("member"))
        .agg(F.sum("followers").alias("followers"))
    )
    joined = salted_join(unnest_outer(spark, sf_dir), audience, "member", "left")
    return joined.select("id", "member", "followers")


@query(
    """SELECT c_custkey, c_name, c_mktsegment FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice >= 490000)""",
    name="prune_entities",
)
def prune_entities_by_items(spark, sf_dir):
    # The minimum is tested on text, as for raw items.
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_totalprice").cast("string").alias("price")
    )
    ids = minimum_number(orders, "price", 490_000).select("o_custkey").distinct()
    customers = table(spark, sf_dir, "customer")
    pruned = prune_entities(customers, ids, "c_custkey")
    return pruned.select("c_custkey", "c_name", "c_mktsegment")


_ALL_IDS = f"""
    raw AS ({RAW_ITEMS_SQL}),
    kinds AS (SELECT id_artists, {oracle.list_kind("id_artists")} AS kind FROM raw),
    all_ids AS (
        SELECT DISTINCT id FROM (
            SELECT {oracle.trim("unnest(" + oracle.list_elements("id_artists", "kind") + ")")}
                AS id
            FROM kinds
        ) WHERE id <> ''
    )
"""


@query(f"WITH {_ALL_IDS} SELECT id FROM all_ids")
def distinct_list_ids(spark, sf_dir):
    return entity_ids(raw_items(spark, sf_dir))


@query(
    f"""WITH {_ALL_IDS}, entities AS ({oracle.RAW_ENTITIES_SQL})
    SELECT * FROM entities WHERE id IN (SELECT id FROM all_ids)"""
)
def prune_by_list(spark, sf_dir):
    return prune_entities(raw_entities(spark, sf_dir), distinct_list_ids(spark, sf_dir))


# --- filters ----------------------------------------------------------------


@query(
    f"""WITH raw AS ({RAW_ITEMS_SQL})
    SELECT id, name, duration_ms FROM raw
    WHERE NOT {oracle.blank("name")} AND {oracle.number("duration_ms")} >= 60000"""
)
def required_and_min(spark, sf_dir):
    named = required_text(raw_items(spark, sf_dir), "name")
    return minimum_number(named, "duration_ms", 60_000).select("id", "name", "duration_ms")


@query(
    f"""WITH raw AS ({RAW_ITEMS_SQL})
    SELECT id, id_artists FROM raw WHERE {oracle.list_kind("id_artists")} <> 'drop'"""
)
def usable_lists(spark, sf_dir):
    return usable_list(raw_items(spark, sf_dir), "id_artists").select("id", "id_artists")


# --- column expressions -----------------------------------------------------


@query(
    f"""WITH raw AS ({RAW_ITEMS_SQL})
    SELECT id, release_date, {oracle.date_part("release_date", "year")} AS release_year,
        {oracle.date_part("release_date", "month")} AS release_month,
        {oracle.date_part("release_date", "day")} AS release_day
    FROM raw""",
    name="date_parts",
)
def date_split(spark, sf_dir):
    parts = date_parts(F.col("release_date"))
    return raw_items(spark, sf_dir).select(
        "id",
        "release_date",
        parts.year.alias("release_year"),
        parts.month.alias("release_month"),
        parts.day.alias("release_day"),
    )


@query(
    f"""SELECT event_id, {oracle.band("(value / 100)")} AS level,
        CASE WHEN value / 100 - 0.1 < 0 THEN ''
             ELSE {oracle.band("(value / 100 - 0.1)")} END AS strict_level
    FROM events""",
    name="band",
)
def number_band(spark, sf_dir):
    score = F.col("value") / 100
    return table(spark, sf_dir, "events").select(
        "event_id",
        band_number(score).alias("level"),
        band_number(score - 0.1, strict_lower=True).alias("strict_level"),
    )


# One number text per event, in a spelling that goes with the event type.
_HUNDREDTHS = "cast(floor(value * 100) as bigint)"
_NUMBER_TEXT = f"""CASE event_type
    WHEN 'view' THEN concat('{chr(0x3000)}', {_HUNDREDTHS}, 'e-4 ')
    WHEN 'click' THEN concat({_HUNDREDTHS}, '.5d')
    WHEN 'signup' THEN concat('-.', {_HUNDREDTHS})
    WHEN 'purchase' THEN concat('0x', {_HUNDREDTHS})
    ELSE CASE WHEN value < 50 THEN ' ' WHEN value < 100 THEN ''
              WHEN value < 150 THEN 'Infinity' WHEN value < 200 THEN 'inf'
              ELSE concat(event_id, 'abc') END END"""
_NUMBERS_SQL = f"numbers AS (SELECT event_id, {_NUMBER_TEXT} AS x FROM events)"


def _number_texts(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.selectExpr("event_id", f"{_NUMBER_TEXT} AS x")


@query(f"WITH {_NUMBERS_SQL} SELECT event_id, {oracle.text_band('x')} AS level FROM numbers", name="band_text")
def text_band(spark, sf_dir):
    labelled = with_band(_number_texts(spark, sf_dir), "x", "level")
    return labelled.select("event_id", "level")


@query(f"WITH {_NUMBERS_SQL} SELECT event_id, {oracle.number('x')} AS number FROM numbers", name="strict_number")
def strict_numbers(spark, sf_dir):
    number = strict_number(F.col("x")).alias("number")
    return _number_texts(spark, sf_dir).select("event_id", number)


@query(f"WITH {_NUMBERS_SQL} SELECT event_id, {oracle.integer('x')} AS number FROM numbers", name="lenient_int")
def lenient_integers(spark, sf_dir):
    number = lenient_int(F.col("x")).alias("number")
    return _number_texts(spark, sf_dir).select("event_id", number)


@query(f"WITH {_NUMBERS_SQL} SELECT event_id, {oracle.double('x')} AS number FROM numbers", name="lenient_double")
def lenient_doubles(spark, sf_dir):
    number = lenient_double(F.col("x")).alias("number")
    return _number_texts(spark, sf_dir).select("event_id", number)


_FLAG_TEXT = """CASE event_type WHEN 'view' THEN 'TRUE' WHEN 'click' THEN 'false'
    WHEN 'signup' THEN '1' WHEN 'purchase' THEN '0'
    ELSE CASE WHEN value < 100 THEN ' true' ELSE '' END END"""


@query(f"SELECT event_id, {oracle.boolean('(' + _FLAG_TEXT + ')')} AS flag FROM events", name="bool_parse")
def boolean_parse(spark, sf_dir):
    flags = table(spark, sf_dir, "events").selectExpr("event_id", f"{_FLAG_TEXT} AS x")
    return flags.select("event_id", lenient_boolean(F.col("x")).alias("flag"))


# List texts: JSON objects, scalars, nested and broken lists besides good ones.
_LIST_TEXT = """replace(CASE event_type
    WHEN 'view' THEN props
    WHEN 'click' THEN concat('[^u', user_id, '^, "e, ', event_id, '"]')
    WHEN 'signup' THEN concat('[^u', user_id, '^, ', event_id, ']')
    WHEN 'purchase' THEN concat('[^u', user_id, '^] ', event_id)
    ELSE CASE WHEN value < 50 THEN '' WHEN value < 100 THEN concat(user_id)
              WHEN value < 150 THEN concat('[[^u', user_id, '^]]')
              WHEN value < 200 THEN ' [ ] ' WHEN value < 250 THEN 'null'
              ELSE concat('u', user_id) END END, '^', chr(39))"""
_LISTS_SQL = f"lists AS (SELECT event_id, {_LIST_TEXT} AS x FROM events)"


@query(
    f"""WITH {_LISTS_SQL}, kinds AS (SELECT *, {oracle.list_kind("x")} AS kind FROM lists)
    SELECT event_id, kind,
        CASE WHEN kind <> 'drop'
             THEN array_to_string({oracle.list_elements("x", "kind")}, '|') END AS elements
    FROM kinds"""
)
def list_kinds(spark, sf_dir):
    lists = table(spark, sf_dir, "events").selectExpr("event_id", f"{_LIST_TEXT} AS x")
    kinds = lists.withColumn("kind", list_kind(F.col("x")))
    elements = list_elements(F.col("x"), F.col("kind"))
    return kinds.select("event_id", "kind", F.array_join(elements, "|").alias("elements"))


# Array literals. The checking SQL takes each spelling apart by its own rule.
_ARRAY_TEXT = """replace(CASE event_type
    WHEN 'view' THEN concat(' [ ^u', user_id, '^ ,^it^s ', event_id, '^ ] ')
    WHEN 'click' THEN concat('["u, ', user_id, '", ^null^, ^e^]')
    WHEN 'signup' THEN concat('[^u, ', user_id, '^]')
    WHEN 'purchase' THEN '[]'
    ELSE CASE WHEN value < 100 THEN '' ELSE concat('[[', user_id, ']]') END END,
    '^', chr(39))"""


@query(
    f"""WITH arrays AS (SELECT event_id, event_type, {_ARRAY_TEXT} AS x FROM events),
    bodies AS (SELECT *, {oracle.array_body("x")} AS body FROM arrays)
    SELECT event_id,
        CASE event_type
            WHEN 'click' THEN concat(regexp_extract(body, '"(.*)"', 1), '|<null>|e')
            WHEN 'purchase' THEN ''
            ELSE CASE WHEN x <> '' THEN regexp_replace(body, '\\s*,\\s*', '|', 'g') END
        END AS elements,
        CASE event_type WHEN 'click' THEN 3 WHEN 'purchase' THEN 0
            ELSE CASE WHEN x <> '' THEN CAST(len(string_split(body, ',')) AS INTEGER) END
        END AS n_elements
    FROM bodies""",
    name="array_literal",
)
def array_literals(spark, sf_dir):
    arrays = table(spark, sf_dir, "events").selectExpr("event_id", f"{_ARRAY_TEXT} AS x")
    parsed = arrays.withColumn("parsed", array_literal(F.col("x")))
    return parsed.select(
        "event_id",
        F.array_join("parsed", "|", "<null>").alias("elements"),
        F.when(F.col("parsed").isNotNull(), F.size("parsed")).alias("n_elements"),
    )


@query(
    r"""SELECT doc_id, trim(regexp_replace(text, '[^\x20-\x7E]+', '', 'g')) AS text
    FROM documents"""
)
def strip_non_ascii(spark, sf_dir):
    text = F.trim(keep_printable_ascii(F.col("text"))).alias("text")
    return table(spark, sf_dir, "documents").select("doc_id", text)


@query(
    f"""SELECT conv_id, turn,
        {oracle.trim("concat('" + WIDE_SPACE + "', text, ' ', chr(9), chr(160))")} AS text
    FROM conversations"""
)
def wide_trim(spark, sf_dir):
    padded = F.concat(F.lit(WIDE_SPACE), F.col("text"), F.lit(" \t" + chr(0x00A0)))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", trim_wide(padded).alias("text")
    )


@query(f"SELECT page_id, {oracle.marks('html')} AS html FROM pages")
def list_marks_removed(spark, sf_dir):
    html = drop_list_marks(F.col("html")).alias("html")
    return table(spark, sf_dir, "pages").select("page_id", html)


@query(
    f"""WITH raw AS ({RAW_ITEMS_SQL})
    SELECT id, nullif(name, '') AS name, coalesce(nullif(release_date, ''), 'none')
        AS release_date FROM raw"""
)
def empty_as_null(spark, sf_dir):
    return raw_items(spark, sf_dir).select(
        "id",
        empty_to_null(F.col("name")).alias("name"),
        F.coalesce(empty_to_null(F.col("release_date")), F.lit("none")).alias("release_date"),
    )


# --- typed load ---------------------------------------------------------------

_TYPED_ENTITIES_SQL = f"""WITH entities AS ({oracle.RAW_ENTITIES_SQL})
    SELECT id, {oracle.integer("followers")} AS followers,
        CASE WHEN genres = '[]' THEN ''
             ELSE regexp_replace({oracle.array_body("genres")}, ', "(.*), its"', '|\\1, its')
        END AS genres,
        name, {oracle.integer("popularity")} AS popularity
    FROM entities"""


def _typed_sql(source: str, more: str = "") -> str:
    return f"""SELECT nullif(id, '') AS id, nullif(name, '') AS name,
        {oracle.integer("popularity")} AS popularity,
        {oracle.integer("duration_ms")} AS duration_ms,
        {oracle.boolean("explicit")} AS explicit,
        nullif(release_date, '') AS release_date,
        {oracle.double("danceability")} AS danceability,
        {oracle.double("energy")} AS energy{more} FROM {source}"""


@query(
    f"WITH raw AS ({RAW_ITEMS_SQL}) "
    + _typed_sql("raw", f", {oracle.list_text('id_artists')} AS id_artists"),
    name="typed_projection",
)
def typed_columns(spark, sf_dir):
    typed = typed_projection(raw_items(spark, sf_dir))
    return typed.withColumn("id_artists", F.array_join("id_artists", "|"))


@query(_TYPED_ENTITIES_SQL)
def typed_lists(spark, sf_dir):
    typed = typed_projection(raw_entities(spark, sf_dir))
    return typed.withColumn("genres", F.array_join("genres", "|"))


# --- prepare and prune -------------------------------------------------------


@query(f"WITH {oracle.PREPARED} SELECT * FROM prepared", name="prepare_items")
def prepared_items(spark, sf_dir):
    return prepare_items(raw_items(spark, sf_dir))


@query(
    f"""WITH raw AS ({RAW_ITEMS_SQL})
    SELECT id, name, duration_ms, '' AS release_year, '' AS release_month,
        '' AS release_day, '' AS danceability_level
    FROM raw WHERE NOT {oracle.blank("name")} AND {oracle.number("duration_ms")} >= 60000"""
)
def prepare_without_optional(spark, sf_dir):
    return prepare_items(raw_items(spark, sf_dir).select("id", "name", "duration_ms"))


@query(f"WITH {oracle.PREPARED} SELECT * FROM kept_entities")
def prepare_then_prune(spark, sf_dir):
    classified = classify_items(raw_items(spark, sf_dir).select("name", "duration_ms", "id_artists"))
    ids = entity_ids(classified.filter(F.col("reject_reason").isNull()))
    return prune_entities(raw_entities(spark, sf_dir), ids)


@query(
    f"""WITH {oracle.PREPARED}
    SELECT reject_reason, count(*) AS n_rows FROM classified
    WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    name="rejects_by_reason",
)
def rejected_by_reason(spark, sf_dir):
    return rejects_by_reason(rejected_items(raw_items(spark, sf_dir)))


@query(
    f"""WITH {oracle.PREPARED}
    SELECT id, reject_reason, CASE WHEN reject_reason IS NULL OR reject_reason = 'bad_list'
        THEN kind END AS list_kind FROM classified"""
)
def classified_items(spark, sf_dir):
    classified = classify_items(raw_items(spark, sf_dir))
    return classified.select("id", "reject_reason", "list_kind")


# --- sources and sinks --------------------------------------------------------


@query(f"SELECT {', '.join(RAW_ITEMS)} FROM ({RAW_ITEMS_SQL})")
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "items-csv")
    write_csv(raw_items(spark, sf_dir), path)
    return read_raw(spark, path)


@query(
    """SELECT concat(doc_id) AS doc_id, text, lang, source, concat(n_chars) AS n_chars
    FROM documents"""
)
def csv_round_trip_multi_line(spark, sf_dir):
    path = scratch_path(spark, "documents-csv")
    documents = table(spark, sf_dir, "documents")
    texts = [F.col(c).cast("string").alias(c) for c in ("doc_id", "text", "lang", "source", "n_chars")]
    write_csv(documents.select(*texts), path)
    return read_raw(spark, path, multi_line=True)


@query(
    f"""WITH raw AS ({RAW_ITEMS_SQL})
    SELECT id, {oracle.text_band("danceability")} AS level FROM raw"""
)
def csv_row_transform(spark, sf_dir):
    source, target = scratch_path(spark, "items-csv"), scratch_path(spark, "banded-csv")
    write_csv(raw_items(spark, sf_dir), source)
    jobs.transform_csv(
        spark,
        source,
        target,
        lambda df: df.transform(with_band, "danceability", "level").select("id", "level"),
    )
    return read_raw(spark, target)


@query(
    """SELECT CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS source FROM documents"""
)
def one_column_round_trip(spark, sf_dir):
    path = scratch_path(spark, "one-column")
    source = "CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END AS source"
    write_csv(table(spark, sf_dir, "documents").selectExpr(source), path)
    return read_raw(spark, path)


@query(
    """SELECT concat(c_custkey) AS c_custkey,
        CASE WHEN c_custkey % 7 = 0 AND c_custkey % 5 <> 0 THEN '' ELSE c_name END AS c_name,
        CASE WHEN c_custkey % 7 = 0 AND c_custkey % 5 <> 0 THEN '' ELSE c_mktsegment END
            AS c_mktsegment,
        CASE WHEN c_custkey % 5 = 0 THEN 'long_row' WHEN c_custkey % 7 = 0 THEN 'short_row' END
            AS row_fault
    FROM customer"""
)
def ragged_rows(spark, sf_dir):
    """Every fifth row has a field too many, and every seventh other one too few."""
    path = scratch_path(spark, "ragged")
    line = F.expr(
        """CASE WHEN c_custkey % 5 = 0 THEN concat_ws(',', c_custkey, c_name, c_mktsegment, '"x,y"')
        WHEN c_custkey % 7 = 0 THEN concat(c_custkey)
        ELSE concat_ws(',', c_custkey, c_name, c_mktsegment) END"""
    )
    lines = table(spark, sf_dir, "customer").select(line.alias("c_custkey,c_name,c_mktsegment"))
    lines.write.options(header=True, quote="", sep="\x01").csv(path)
    return read_raw(spark, path, faults="row_fault")


def _row_text(columns) -> str:
    return f"concat_ws('|', {', '.join(columns)})"


_ENTITY_COLUMNS = ("id", "followers", "genres", "name", "popularity")


@query(
    f"""SELECT 'items' AS dataset, {_row_text(RAW_ITEMS)} AS row_text FROM ({RAW_ITEMS_SQL})
    UNION ALL
    SELECT 'entities' AS dataset, {_row_text(_ENTITY_COLUMNS)} AS row_text
    FROM ({oracle.RAW_ENTITIES_SQL})"""
)
def published_datasets(spark, sf_dir):
    items_uri = scratch_path(spark, "published-items")
    entities_uri = scratch_path(spark, "published-entities")
    publish_all(
        {items_uri: raw_items(spark, sf_dir), entities_uri: raw_entities(spark, sf_dir)}
    )
    items, entities = [
        read_raw(spark, uri).selectExpr(f"'{name}' AS dataset", f"{_row_text(columns)} AS row_text")
        for name, uri, columns in (
            ("items", items_uri, RAW_ITEMS), ("entities", entities_uri, _ENTITY_COLUMNS)
        )
    ]
    return items.unionByName(entities)


@query(f"SELECT *, count(*) * 2 AS copies FROM ({_TYPED_ENTITIES_SQL}) GROUP BY ALL")
def load_append_counts(spark, sf_dir):
    path = scratch_path(spark, "loaded")
    name = "loaded_" + path.rsplit("-", 1)[1]
    for _ in range(2):
        load_table(raw_entities(spark, sf_dir), name, "append", path=path)
    loaded = spark.read.parquet(current(spark, path))
    spark.sql(f"DROP TABLE {name}")  # external: its files stay
    listed = loaded.withColumn("genres", F.array_join("genres", "|"))
    return listed.groupBy(*loaded.columns).agg(F.count(F.lit(1)).alias("copies"))


@query(
    f"""SELECT *, 'monday' AS load_id FROM ({_TYPED_ENTITIES_SQL})
    UNION ALL SELECT *, 'tuesday' AS load_id FROM ({_TYPED_ENTITIES_SQL}) WHERE followers > 10"""
)
def append_twice_same_load(spark, sf_dir):
    """Two loads appended, the first one three times and the last time in full."""
    path = scratch_path(spark, "appended")
    name = "appended_" + path.rsplit("-", 1)[1]
    entities = raw_entities(spark, sf_dir)
    some = entities.where("try_cast(followers AS double) > 10")
    for rows, load_id in ((some, "monday"), (some, "tuesday"), (some, "monday"), (entities, "monday")):
        load_table(rows, name, "append", path=path, load_id=load_id)
    loaded = spark.read.parquet(path)
    spark.sql(f"DROP TABLE {name}")  # external: its files stay
    return loaded.withColumn("genres", F.array_join("genres", "|"))


def _fails(fn) -> bool:
    try:
        fn()
    except Exception:  # whatever the load raises
        return True
    return False


@query(_TYPED_ENTITIES_SQL)
def reload_after_failure(spark, sf_dir):
    """A load, a second one that fails on its values, and the table as it is then."""
    path = scratch_path(spark, "reloaded")
    name = "reloaded_" + path.rsplit("-", 1)[1]
    entities = raw_entities(spark, sf_dir)
    load_table(entities, name, path=path)
    broken = entities.withColumn("followers", F.lit("99999999999"))
    if not _fails(lambda: load_table(broken, name, path=path)):
        raise AssertionError("the second load should have failed")
    rows = spark.table(name).withColumn("genres", F.array_join("genres", "|"))
    kept = scratch_path(spark, "reloaded-rows")
    rows.write.parquet(kept)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(kept)


@query(
    f"""WITH entities AS ({oracle.RAW_ENTITIES_SQL})
    SELECT * FROM (VALUES ('no id column', true, 0), ('no rows', false, 0),
        ('integer out of range', true, 0), ('malformed list', true, 0))
        AS cases(input, failed, n_rows)
    UNION ALL SELECT 'integer out of range as NULL', false, count(*) FROM entities
    UNION ALL SELECT 'malformed list as NULL', false, count(*) FROM entities"""
)
def load_outcomes(spark, sf_dir):
    """What becomes of loads of the entities in unfit forms."""
    entities = raw_entities(spark, sf_dir)
    large = entities.withColumn("followers", F.concat(F.lit("9999999999"), "id"))
    listless = entities.withColumn("genres", F.concat("name", F.lit("]")))
    cases = [
        ("no id column", entities.drop("id"), "fail"),
        ("no rows", entities.filter("id = ''"), "fail"),
        ("integer out of range", large, "fail"),
        ("malformed list", listless, "fail"),
        ("integer out of range as NULL", large, "null"),
        ("malformed list as NULL", listless, "null"),
    ]
    rows = []
    for label, df, on_bad in cases:
        path = scratch_path(spark, "unfit")
        name = "unfit_" + path.rsplit("-", 1)[1]
        failed = _fails(lambda: load_table(df, name, on_bad=on_bad, path=path))
        stored = spark.catalog.tableExists(name)
        rows.append((label, failed, spark.table(name).count() if stored else 0))
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(rows, "input string, failed boolean, n_rows long")


@query(
    f"""WITH {oracle.PREPARED},
    members AS (
        SELECT id, name, popularity, energy, danceability_level,
            trim(unnest(string_split({oracle.marks("id_artists")}, ','))) AS member
        FROM prepared WHERE {oracle.marks("id_artists")} <> ''
        UNION ALL
        SELECT id, name, popularity, energy, danceability_level, NULL AS member
        FROM prepared WHERE {oracle.marks("id_artists")} = ''
    )
    SELECT m.id AS track_id, m.name, {oracle.integer("m.popularity")} AS popularity,
        {oracle.double("m.energy")} AS energy,
        nullif(m.danceability_level, '') AS danceability,
        CAST(coalesce(sum({oracle.integer("e.followers")}), 0) AS BIGINT) AS artist_followers
    FROM members m LEFT JOIN kept_entities e ON e.id = m.member GROUP BY 1, 2, 3, 4, 5"""
)
def catalogue_from_csv(spark, sf_dir):
    """Raw CSV to prepared CSV, published, loaded into tables and summarised."""
    base = scratch_path(spark, "catalogue")
    raw = _raw_csv(spark, sf_dir, base)
    prepared = [f"{base}/prepared-items", f"{base}/prepared-entities"]
    jobs.prepare_catalogue(spark, *raw, *prepared)
    published = [f"{base}/published-items", f"{base}/published-entities"]
    jobs.publish_catalogue(spark, *prepared, *published)
    loaded = [f"{base}/items", f"{base}/entities"]
    suffix = base.rsplit("-", 1)[1]
    for uri, name, path in zip(published, ("items_", "entities_"), loaded):
        load_table(read_prepared(spark, uri), name + suffix, path=path)
        spark.sql(f"DROP TABLE {name}{suffix}")  # external: its files stay
    return views.track_summary(*[spark.read.parquet(current(spark, p)) for p in loaded])


_LOADED = f"""{oracle.PREPARED},
    loaded AS (
        SELECT id, name, {oracle.integer("popularity")} AS popularity,
            {oracle.double("energy")} AS energy, {oracle.integer("release_year")} AS release_year,
            nullif(danceability_level, '') AS danceability, {oracle.marks("id_artists")} AS listed
        FROM prepared
    ),
    members AS (
        SELECT *, trim(unnest(string_split(listed, ','))) AS member FROM loaded WHERE listed <> ''
        UNION ALL SELECT *, NULL AS member FROM loaded WHERE listed = ''
    ),
    audience AS (
        SELECT id, name, {oracle.integer("followers")} AS followers FROM kept_entities
    )"""


def _cells(*columns: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce({c} || '', '-')" for c in columns) + ")"


_SUMMARY_CELLS = ("track_id", "name", "popularity", "danceability", "artist_followers")
_TOP_CELLS = ("release_year", "track_id", "name")
_PAIR_CELLS = ("artist_id", "artist_name", "track_id", "track_name")


@query(
    f"""WITH {_LOADED},
    summary AS (
        SELECT m.id AS track_id, m.name, popularity, energy, danceability,
            CAST(coalesce(sum(a.followers), 0) AS BIGINT) AS artist_followers
        FROM members m LEFT JOIN audience a ON a.id = m.member GROUP BY 1, 2, 3, 4, 5
    ),
    ranked AS (
        SELECT release_year, id AS track_id, name, energy, row_number() OVER (
            PARTITION BY release_year ORDER BY energy DESC NULLS FIRST, id, name) AS place
        FROM loaded
    ),
    pairs AS (
        SELECT a.id AS artist_id, a.name AS artist_name, m.id AS track_id, m.name AS track_name
        FROM members m JOIN audience a ON a.id = m.member WHERE a.followers > 0
    )
    SELECT 'track_summary' AS view, {_cells(*_SUMMARY_CELLS)} AS cells, energy FROM summary
    UNION ALL
    SELECT 'most_energising_track_per_year', {_cells(*_TOP_CELLS)}, energy
    FROM ranked WHERE place = 1
    UNION ALL SELECT 'artist_track_summary', {_cells(*_PAIR_CELLS)}, NULL FROM pairs"""
)
def stored_views(spark, sf_dir):
    """The three stored views over tables that ``load_catalogue`` has loaded."""
    base = scratch_path(spark, "stored")
    database = "refrain_" + base.rsplit("-", 1)[1]
    items, entities = f"{base}/items", f"{base}/entities"
    raw = _raw_csv(spark, sf_dir, base)
    jobs.prepare_catalogue(spark, *raw, items, entities)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/database'")
    try:
        tables = [f"{database}.{views.ITEMS_TABLE}", f"{database}.{views.ENTITIES_TABLE}"]
        jobs.load_catalogue(spark, items, entities, *tables, fmt="parquet")
        views.create_catalog_views(spark, *tables, database=database)
        shown = [
            spark.table(f"{database}.{name}").selectExpr(
                f"'{name}' AS view", f"{_cells(*cells)} AS cells", f"{energy} AS energy"
            )
            for name, cells, energy in (
                (views.SUMMARY_VIEW, _SUMMARY_CELLS, "energy"),
                (views.TOP_VIEW, _TOP_CELLS, "energy"),
                (views.PAIRS_VIEW, _PAIR_CELLS, "cast(NULL AS double)"),
            )
        ]
        shown[0].unionByName(shown[1]).unionByName(shown[2]).write.parquet(f"{base}/shown")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")  # its tables are external
    return spark.read.parquet(f"{base}/shown")


@query(
    f"""WITH {oracle.PREPARED}
    SELECT count(*) AS rows,
        count(*) FILTER (reject_reason IS NULL) AS kept,
        CAST(0 AS BIGINT) AS long_row,
        count(*) FILTER (reject_reason = 'no_name') AS no_name,
        count(*) FILTER (reject_reason = 'bad_number') AS bad_number,
        count(*) FILTER (reject_reason = 'too_small') AS too_small,
        count(*) FILTER (reject_reason = 'bad_list') AS bad_list,
        count(*) FILTER (reject_reason IS NULL AND kind = 'raw') AS raw_lists,
        CAST(0 AS BIGINT) AS short_rows,
        (SELECT count(*) FROM kept_entities) AS entities
    FROM classified"""
)
def prepare_report(spark, sf_dir):
    """The counts a prepare run takes while it writes."""
    base = scratch_path(spark, "report")
    raw = _raw_csv(spark, sf_dir, base)
    report = jobs.prepare_catalogue(spark, *raw, f"{base}/items", f"{base}/entities")
    return spark.createDataFrame([asdict(report)], "rows long, kept long, "
        "long_row long, no_name long, bad_number long, too_small long, bad_list long, "
        "raw_lists long, short_rows long, entities long")


# --- streaming ----------------------------------------------------------------

#: Raw items that one task writes into a file, about 100 MB; small tables make four files.
ROWS_A_FILE = 1_000_000



@query(f"WITH {oracle.PREPARED} SELECT * FROM prepared")
def streamed_items(spark, sf_dir):
    """The prepare steps over a folder of CSV files, read as a stream."""
    base = scratch_path(spark, "stream")
    folder = _write_raw(raw_items(spark, sf_dir), f"{base}/in")
    raw = stream_raw_csv(spark, folder, list(RAW_ITEMS))
    run = write_prepared_stream(raw, f"{base}/out", f"{base}/checkpoint")
    run.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query(
    f"""WITH {oracle.PREPARED}
    SELECT id, coalesce(reject_reason, 'kept') AS outcome FROM classified
    UNION ALL SELECT id, 'entity' AS outcome FROM kept_entities"""
)
def streamed_batches(spark, sf_dir):
    """Items kept and rejected and entities kept, by a stream in several batches."""
    base = scratch_path(spark, "batches")
    raw = raw_items(spark, sf_dir)
    n_files = max(4, -(-raw.count() // ROWS_A_FILE))
    folder = _write_raw(raw.repartition(n_files, "id"), f"{base}/in")
    entities = raw_entities(spark, sf_dir)
    run = prepare_stream(
        spark, f"{folder}/*.csv", lambda: entities, f"{base}/out", f"{base}/checkpoint",
        files_per_batch=-(-n_files // 2),
    )
    run.awaitTermination()
    items, rejects, found = [read_batches(spark, f"{base}/out", p) for p in ("items", "rejects", "entities")]
    parts = [
        items.select("id", F.lit("kept").alias("outcome")),
        rejects.select("id", F.col("reject_reason").alias("outcome")),
        found.select("id", F.lit("entity").alias("outcome")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
