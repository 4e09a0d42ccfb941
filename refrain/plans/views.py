"""The standing questions over the loaded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refrain.operators.joins import SALTS, hot_keys
from refrain.operators.ranking import top_per_group
from refrain.operators.unnest import unnest_list
from refrain.sinks.tables import table_hot_keys

# Names of the loaded tables and of the views over them.
ITEMS_TABLE, ENTITIES_TABLE = "tracks", "artists"
SUMMARY_VIEW = "track_summary"
TOP_VIEW = "most_energising_track_per_year"
PAIRS_VIEW = "artist_track_summary"

# Each view is defined once, as SQL over {items} and {entities}. List brackets and
# quotes go, as in ``drop_list_marks``; hot ids are spread over salts, as in
# ``salted_join``.
_MEMBERS = "split(nullif(translate(array_join(id_artists, ','), '[]\\'\"', ''), ''), ',')"


def _salts(hot: Sequence[str], member: str = "0", entity: str = "0") -> dict[str, str]:
    """How members and entities get their salts.

    Items without members, which find no entity, are spread like those of hot ids.
    """
    if not hot:
        none = f"CASE WHEN member IS NULL THEN spread ELSE {member} END"
        return {"member_salt": none, "entity_salt": entity}
    listed = ", ".join(_literal(key) for key in hot)
    return {
        "member_salt": f"CASE WHEN member IS NULL OR trim(member) IN ({listed}) THEN spread ELSE {member} END",
        "entity_salt": f"""explode(CASE WHEN id IN ({listed})
            THEN sequence(0, {SALTS} - 1) ELSE array({entity}) END)""",
    }


def _literal(text: str) -> str:
    """A SQL literal of any text; braces too would mean something in a template."""
    return f"cast(unhex('{text.encode().hex()}') AS string)"


# Followers are summed per entity before the join, which keeps the sums and spares
# the product of repeated ids on both sides. A second key that is always 0, though the
# optimizer cannot tell, gives the join exchanges of its own, also behind that sum, so
# that adaptive execution can split a skewed partition.
def _summary(hot: Sequence[str] = ()) -> str:
    salts = _salts(hot, "pmod(hash(trim(member)), 1)", "pmod(hash(id), 1)")
    return f"""
    WITH listed AS (
      SELECT id, name, popularity, energy, danceability_level,
             cast(pmod(xxhash64(id, name), {SALTS}) AS int) AS spread,
             explode_outer({_MEMBERS}) AS member
      FROM {{items}}
    ), members AS (
      SELECT *, {salts["member_salt"]} AS salt FROM listed
    ), audience AS (
      SELECT id, followers, {salts["entity_salt"]} AS salt
      FROM (SELECT id, sum(followers) AS followers FROM {{entities}}
            WHERE id IS NOT NULL GROUP BY id)
    )
    SELECT m.id AS track_id, m.name, m.popularity, m.energy,
           m.danceability_level AS danceability,
           coalesce(sum(audience.followers), 0) AS artist_followers
    FROM members m LEFT JOIN audience
      ON audience.id = trim(m.member) AND audience.salt = m.salt
    GROUP BY ALL
"""


# The first item of a year is a minimum, merged within each task before the shuffle:
# NULL energy first, then the greatest, NaN above all, then the least id and name.
_TOP = """
    SELECT best.* FROM (
      SELECT min_by(
               struct(release_year, id AS track_id, name, energy),
               struct(energy IS NOT NULL, NOT isnan(energy), -energy, id IS NULL, id, name IS NULL, name)
             ) AS best
      FROM {items} GROUP BY release_year
    )
"""


# A plain comparison drops NULL followers like 0 and reaches the Parquet scan.
def _pairs(hot: Sequence[str] = ()) -> str:
    salts = _salts(hot)
    return f"""
    WITH listed AS (
      SELECT id, name, cast(pmod(xxhash64(id, name), {SALTS}) AS int) AS spread,
             explode({_MEMBERS}) AS member
      FROM {{items}}
    ), members AS (
      SELECT *, {salts["member_salt"]} AS salt FROM listed
    ), followed AS (
      SELECT id, name, {salts["entity_salt"]} AS salt
      FROM {{entities}} WHERE followers > 0
    )
    SELECT e.id AS artist_id, e.name AS artist_name,
           m.id AS track_id, m.name AS track_name
    FROM members m INNER JOIN followed e
      ON e.id = trim(m.member) AND e.salt = m.salt
"""


def definitions(hot: Sequence[str] = ()) -> dict[str, str]:
    return {SUMMARY_VIEW: _summary(hot), TOP_VIEW: _TOP, PAIRS_VIEW: _pairs(hot)}


def hot_members(items: DataFrame) -> list[str]:
    """Ids that a large share of the items' list elements are; runs a job."""
    return hot_keys(unnest_list(items.select("id_artists"), "id_artists", "member"), "member")


def track_summary(items: DataFrame, entities: DataFrame, hot: Sequence[str] = ()) -> DataFrame:
    """Each item with the summed followers of its entities, 0 if there are none.

    Repeated entities and repeated items add up as joined rows would. ``hot`` ids,
    as ``hot_members`` finds them, are spread.
    """
    return items.sparkSession.sql(_summary(hot), items=items, entities=entities)


def most_energising_track_per_year(items: DataFrame, k: int = 1) -> DataFrame:
    """The ``k`` most energetic items of each release year, NULL energy first.

    Ties go to the smallest id, then name.
    """
    columns = ["release_year", F.col("id").alias("track_id"), "name", "energy"]
    return top_per_group(items.select(*columns), "release_year", "energy", ["track_id", "name"], k)


def artist_track_summary(items: DataFrame, entities: DataFrame, hot: Sequence[str] = ()) -> DataFrame:
    """Every entity that has followers with each of its items; ``hot`` as above."""
    return items.sparkSession.sql(_pairs(hot), items=items, entities=entities)


def create_views(
    spark: SparkSession, items: DataFrame | None = None, entities: DataFrame | None = None
) -> None:
    """Create or replace the three temporary views.

    Without DataFrames they are over the tables and, being stored as text, follow
    them through every reload. Ids that were hot when the items were loaded are
    spread; reloads change nothing but how evenly the work is dealt.
    """
    if items is None and entities is None:
        _create(spark, "TEMPORARY VIEW", ITEMS_TABLE, ENTITIES_TABLE)
        return
    items = spark.table(ITEMS_TABLE) if items is None else items
    entities = spark.table(ENTITIES_TABLE) if entities is None else entities
    track_summary(items, entities).createOrReplaceTempView(SUMMARY_VIEW)
    most_energising_track_per_year(items).createOrReplaceTempView(TOP_VIEW)
    artist_track_summary(items, entities).createOrReplaceTempView(PAIRS_VIEW)


def create_catalog_views(
    spark: SparkSession,
    items: str = ITEMS_TABLE,
    entities: str = ENTITIES_TABLE,
    database: str | None = None,
) -> None:
    """Create or replace the three views in the catalog, for every session."""
    _create(spark, "VIEW", items, entities, f"{database}." if database else "")


def _create(spark: SparkSession, kind: str, items: str, entities: str, prefix: str = "") -> None:
    hot = table_hot_keys(spark, items).get("id_artists", ())
    for name, text in definitions(hot).items():
        body = text.format(items=items, entities=entities)
        spark.sql(f"CREATE OR REPLACE {kind} {prefix}{name} AS {body}")
