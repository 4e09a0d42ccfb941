"""Column names and types of a catalogue."""

from __future__ import annotations

from collections.abc import Iterable

TEXT, INTEGER, DOUBLE, BOOLEAN, TEXT_LIST = (
    "string",
    "int",
    "double",
    "boolean",
    "array<string>",
)

# The type each known column gets at load. Any other column is text.
COLUMN_TYPES = {
    "id": TEXT,
    "name": TEXT,
    "popularity": INTEGER,
    "duration_ms": INTEGER,
    "explicit": BOOLEAN,
    "artists": TEXT,
    "id_artists": TEXT_LIST,
    "release_date": TEXT,
    "release_year": INTEGER,
    "release_month": INTEGER,
    "release_day": INTEGER,
    "danceability": DOUBLE,
    "energy": DOUBLE,
    "key": INTEGER,
    "loudness": DOUBLE,
    "mode": INTEGER,
    "speechiness": DOUBLE,
    "acousticness": DOUBLE,
    "instrumentalness": DOUBLE,
    "liveness": DOUBLE,
    "valence": DOUBLE,
    "tempo": DOUBLE,
    "time_signature": INTEGER,
    "danceability_level": TEXT,
    "followers": INTEGER,
    "genres": TEXT_LIST,
}

# Columns a dataset must have to be loaded.
REQUIRED_COLUMNS = ("id", "name")

# Messages about datasets that cannot be loaded.
MISSING_COLUMNS = 'Missing required CSV headers for table "{table}": {columns}'
EMPTY_DATASET = "CSV file for {table} is empty."

# Fixed value: shortest kept duration, in milliseconds.
MIN_DURATION_MS = 60_000


def free_name(base: str, taken: Iterable[str]) -> str:
    """``base``, with underscores behind it until no column has that name."""
    taken = {name.lower() for name in taken}
    while base.lower() in taken:
        base += "_"
    return base


def column_type(name: str, types: dict[str, str] = COLUMN_TYPES) -> str:
    return types.get(name, TEXT)


def require_columns(
    columns: Iterable[str],
    dataset: str,
    required: Iterable[str] = REQUIRED_COLUMNS,
) -> None:
    """Raise before any job runs when a required column is missing."""
    present = set(columns)
    missing = [name for name in required if name not in present]
    if missing:
        raise ValueError(
            MISSING_COLUMNS.format(table=dataset, columns=", ".join(missing))
        )
