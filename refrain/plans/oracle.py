"""SQL pieces for checking the registered queries with another engine."""

from __future__ import annotations

from refrain.functions.text import WIDE_SPACE
from refrain.plans.driver_tables import (
    HOT_ITEMS_SQL,
    RAW_ENTITIES_SQL,
    RAW_ITEMS_SQL,
    TYPED_ENTITIES_SQL,
    TYPED_ITEMS_SQL,
)

_DECIMAL = r"([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def trim(x: str) -> str:
    return f"trim({x}, '{WIDE_SPACE}')"


def blank(x: str) -> str:
    return f"coalesce({trim(x)}, '') = ''"


def number(x: str) -> str:
    """Strict number, NULL where the library has NaN."""
    t = trim(x)
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN {t} = '' THEN CAST(0 AS DOUBLE)
        WHEN regexp_full_match({t}, '[+-]?(Infinity|{_DECIMAL})') THEN TRY_CAST({t} AS DOUBLE)
        WHEN regexp_full_match({t}, '0[xX][0-9a-fA-F]+')
            THEN CAST(TRY_CAST({t} AS BIGINT) AS DOUBLE) END"""


def band(n: str) -> str:
    return f"""CASE WHEN {n} IS NULL THEN '' WHEN {n} < 0.5 THEN 'Low'
        WHEN {n} <= 0.6 THEN 'Medium' WHEN {n} <= 1 THEN 'High' ELSE '' END"""


def text_band(x: str) -> str:
    return f"CASE WHEN coalesce({x}, '') = '' THEN '' ELSE {band('(' + number(x) + ')')} END"


def integer(x: str) -> str:
    digits = f"regexp_extract({trim(x)}, '^[+-]?[0-9]+')"
    return f"CAST(nullif({digits}, '') AS INTEGER)"


def double(x: str) -> str:
    prefix = f"regexp_extract({trim(x)}, '^[+-]?(Infinity|{_DECIMAL})')"
    return f"TRY_CAST(nullif({prefix}, '') AS DOUBLE)"


def boolean(x: str) -> str:
    return f"""CASE WHEN lower({x}) IN ('true', '1') THEN true
        WHEN lower({x}) IN ('false', '0') THEN false END"""


def clean_date(x: str) -> str:
    return rf"trim(regexp_replace(coalesce({x}, ''), '[^\x20-\x7E]+', '', 'g'))"


def date_part(x: str, part: str) -> str:
    """Year, month or day out of whichever spelling matches."""
    c = clean_date(x)
    iso = r"^(\d{4})-(\d{2})-(\d{2})$"
    day_first = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    group = {"year": (1, 3), "month": (2, 2), "day": (3, 1)}[part]
    found = [f"regexp_extract({c}, '{iso}', {group[0]})"]
    found.append(f"regexp_extract({c}, '{day_first}', {group[1]})")
    if part == "year":
        found.append(rf"regexp_extract({c}, '^\d{{4}}$')")
    return f"concat({', '.join(found)})"


def as_json(x: str) -> str:
    return f"replace({x}, '''', '\"')"


def list_kind(x: str) -> str:
    q = as_json(x)
    return f"""CASE WHEN coalesce({x}, '') = '' THEN 'empty'
        WHEN NOT json_valid({q}) THEN 'raw'
        WHEN json_type({q}) <> 'ARRAY' THEN 'drop'
        WHEN len(list_filter(json_extract({q}, '$[*]'),
                 lambda e: json_type(e) <> 'VARCHAR')) > 0 THEN 'drop'
        ELSE 'list' END"""


def list_elements(x: str, kind: str) -> str:
    return f"""CASE {kind} WHEN 'list' THEN json_extract_string({as_json(x)}, '$[*]')
        WHEN 'raw' THEN [{x}] ELSE [] END"""


def marks(x: str) -> str:
    return rf"""regexp_replace({x}, '[\[\]''"]', '', 'g')"""


def array_body(x: str) -> str:
    """Text between the outer brackets without single quotes."""
    inner = rf"regexp_replace(regexp_replace({x}, '^\s*\[\s*', ''), '\s*\]\s*$', '')"
    return f"replace({inner}, '''', '')"


def list_text(x: str) -> str:
    """Elements of a list text without commas inside elements, with | between."""
    body = rf"trim({array_body(x)})"
    return rf"""CASE WHEN {x} <> '' THEN
        replace(regexp_replace({body}, '\s*,\s*', '|', 'g'), '"', '') END"""


def members(items: str) -> str:
    """Items with the view's reading of their member lists, one row per member."""
    return f"""
    items AS ({items}),
    entities AS ({TYPED_ENTITIES_SQL}),
    listed AS (
        SELECT *, {marks("replace(members, '|', ',')")} AS listed_text FROM items
    ),
    inner_members AS (
        SELECT *, trim(unnest(string_split(listed_text, ','))) AS member
        FROM listed WHERE listed_text <> ''
    ),
    outer_members AS (
        SELECT * FROM inner_members
        UNION ALL
        SELECT *, NULL AS member FROM listed WHERE coalesce(listed_text, '') = ''
    )
"""


MEMBERS = members(TYPED_ITEMS_SQL)
HOT_MEMBERS = members(HOT_ITEMS_SQL)

_RAW_COLUMNS = (
    "id, name, popularity, duration_ms, explicit, id_artists, release_date, "
    "danceability, energy"
)

# Raw items classified and prepared, their ids, and the raw entities kept.
PREPARED = f"""
    raw AS ({RAW_ITEMS_SQL}),
    measured AS (
        SELECT *, {number("duration_ms")} AS duration, {list_kind("id_artists")} AS kind
        FROM raw
    ),
    classified AS (
        SELECT *, CASE WHEN {blank("name")} THEN 'no_name'
            WHEN duration IS NULL THEN 'bad_number'
            WHEN duration < 60000 THEN 'too_small'
            WHEN kind = 'drop' THEN 'bad_list' END AS reject_reason
        FROM measured
    ),
    kept AS (SELECT * FROM classified WHERE reject_reason IS NULL),
    prepared AS (
        SELECT {_RAW_COLUMNS},
            {date_part("release_date", "year")} AS release_year,
            {date_part("release_date", "month")} AS release_month,
            {date_part("release_date", "day")} AS release_day,
            {text_band("danceability")} AS danceability_level
        FROM kept
    ),
    ids AS (
        SELECT DISTINCT id FROM (
            SELECT {trim("unnest(" + list_elements("id_artists", "kind") + ")")} AS id
            FROM kept
        ) WHERE id <> ''
    ),
    raw_entities AS ({RAW_ENTITIES_SQL}),
    kept_entities AS (SELECT * FROM raw_entities WHERE id IN (SELECT id FROM ids))
"""
