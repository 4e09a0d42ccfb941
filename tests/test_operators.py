"""Operators and views on hand-made tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from refrain.operators import joins, prepare
from refrain.operators.quality import rejects_by_reason
from refrain.operators.ranking import top_per_group
from refrain.operators.typed import typed_projection
from refrain.operators.unnest import unnest_list
from refrain.plans import views
from refrain.schemas import require_columns

ITEM_SCHEMA = (
    "id string, name string, duration_ms string, id_artists string, "
    "release_date string, danceability string"
)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def items(spark, *data):
    return spark.createDataFrame(list(data), ITEM_SCHEMA)


def test_prepare_valid_and_short(spark):
    df = items(
        spark,
        ("k1", "Prelude", "41234", "['e7']", None, None),
        ("k2", " Long Song ", "241000", "['e7','e9']", "1987-06-15", "0.55"),
    )
    kept = prepare.prepare_items(df, 60000)
    assert kept.columns == [
        *df.columns, "release_year", "release_month", "release_day", "danceability_level",
    ]
    assert rows(kept) == Counter([
        ("k2", " Long Song ", "241000", "['e7','e9']", "1987-06-15", "0.55",
         "1987", "06", "15", "Medium"),
    ])
    assert rows(prepare.entity_ids(kept)) == Counter([("e7",), ("e9",)])


def test_optional_columns_read_as_blank(spark):
    df = spark.createDataFrame([("a", "x", "70000"), ("b", "", "70000")], "id string, name string, duration_ms string")
    kept = prepare.prepare_items(df)
    assert rows(kept) == Counter([("a", "x", "70000", "", "", "", "")])
    assert prepare.entity_ids(kept).collect() == []
    assert rows(prepare.classify_items(df).select("id", "reject_reason")) == Counter([("a", None), ("b", "no_name")])


def test_prepare_limits_and_reasons(spark):
    df = items(
        spark,
        ("a", "x", "60000", "[]", "", ""),
        ("b", "x", "59999", "[]", "", ""),
        ("c", "x", "", "[]", "", ""),
        ("d", "x", None, "[]", "", ""),
        ("e", " \t", "70000", "[]", "", ""),
        ("f", None, "70000", "[]", "", ""),
        ("g", "x", "7e4", "raw", "", ""),
        ("h", "x", "70000", "[1]", "", ""),
        ("i", "x", "70000", None, None, None),
        ("j", "x", "abc", "[1]", "", ""),
        ("k", "x", "0xFFFFF", "", "", ""),
    )
    kept = prepare.prepare_items(df)
    assert {r["id"] for r in kept.collect()} == {"a", "g", "i", "k"}
    rejected = prepare.rejected_items(df)
    assert rejected.columns == [*df.columns, "reject_reason"]
    assert {(r["id"], r["reject_reason"]) for r in rejected.collect()} == {
        ("b", "too_small"), ("c", "too_small"), ("d", "bad_number"), ("e", "no_name"),
        ("f", "no_name"), ("h", "bad_list"), ("j", "bad_number"),
    }
    assert rows(rejects_by_reason(rejected)) == Counter([
        ("too_small", 2), ("bad_number", 2), ("no_name", 2), ("bad_list", 1)
    ])
    assert rows(prepare.entity_ids(kept)) == Counter([("raw",)])


def test_prepare_replaces_columns_of_the_same_name(spark):
    df = items(spark, ("a", "x", "60000", "[]", "2001", "")).withColumn(
        "release_year", F.lit("old")
    )
    out = prepare.prepare_items(df)
    assert out.columns[-4:] == [
        "release_year", "release_month", "release_day", "danceability_level"
    ]
    (row,) = out.collect()
    assert row["release_year"] == "2001"


def test_prune_entities(spark):
    ids = spark.createDataFrame([("e7",), ("e9",), ("e7",)], "id string")
    entities = spark.createDataFrame(
        [("e7", "Seven"), ("e8", "Eight"), ("e7", "Seven II"), (" e9", "untrimmed"), (None, "none")],
        "id string, name string",
    )
    expected = Counter([("e7", "Seven"), ("e7", "Seven II")])
    pruned = prepare.prune_entities(entities, ids)
    assert pruned.columns == ["id", "name"] and rows(pruned) == expected


def test_entity_ids_trims_and_drops_blanks(spark):
    df = items(
        spark,
        ("a", "x", "1", "[' a ', '', 'b']", "", ""),
        ("b", "x", "1", " raw ", "", ""),
        ("c", "x", "1", "['a']", "", ""),
    )
    assert rows(prepare.entity_ids(df)) == Counter([("a",), ("b",), ("raw",)])


def test_unnest(spark):
    df = spark.createDataFrame(
        [(1, ["a", " b "]), (2, []), (3, None), (4, ["['x", '"y"]']), (5, ["p,q", None]),
         (6, [None]), (7, ["", "z"])],
        "k int, l array<string>",
    )
    inner = [(1, "a"), (1, "b"), (4, "x"), (4, "y"), (5, "p"), (5, "q"), (7, ""), (7, "z")]
    assert rows(unnest_list(df, "l", "e")) == Counter(inner)
    outer = [*inner, (2, None), (3, None), (6, None)]
    assert rows(unnest_list(df, "l", "e", outer=True)) == Counter(outer)


TRACKS = [
    ("t1", "n1", 1, 0.5, "Low", ["a", "b"], 2000),
    ("t2", "n2", 1, None, "Low", [], 2000),
    ("t3", "n3", 1, 0.9, None, None, None),
    ("t4", "n4", 1, 0.3, "High", ["a", "a"], 2001),
    ("t5", "n5", 1, 0.3, "High", ["zz"], 2001),
    ("t6", "n6", None, 0.1, "High", ["d", "c"], 2001),
    ("t7", "n7", 7, 0.1, "High", ["d"], 2002),
    ("t7", "n7", 7, 0.1, "High", ["d"], 2002),
]
ARTISTS = [
    ("a", "A", 10), ("b", "B", 0), ("c", "C", None), ("d", "D", 3), ("d", "D2", 4),
    (None, "N", 100),
]
SUMS = {"t1": 10, "t2": 0, "t3": 0, "t4": 20, "t5": 0, "t6": 7, "t7": 14}
TOP = [(None, "t3", "n3", 0.9), (2000, "t2", "n2", None), (2001, "t4", "n4", 0.3),
       (2002, "t7", "n7", 0.1)]
PAIRS = [
    ("a", "A", "t1", "n1"), ("a", "A", "t4", "n4"), ("a", "A", "t4", "n4"),
    ("d", "D", "t6", "n6"), ("d", "D2", "t6", "n6"),
    ("d", "D", "t7", "n7"), ("d", "D2", "t7", "n7"),
    ("d", "D", "t7", "n7"), ("d", "D2", "t7", "n7"),
]


def hand_tables(spark):
    tracks = spark.createDataFrame(
        TRACKS,
        "id string, name string, popularity int, energy double, "
        "danceability_level string, id_artists array<string>, release_year int",
    )
    artists = spark.createDataFrame(ARTISTS, "id string, name string, followers int")
    return tracks, artists


def check_views(summary, top, pairs):
    assert summary.columns == [
        "track_id", "name", "popularity", "energy", "danceability", "artist_followers"
    ]
    assert dict(summary.dtypes)["artist_followers"] == "bigint"
    assert {r["track_id"]: r["artist_followers"] for r in summary.collect()} == SUMS
    assert summary.count() == len(SUMS)
    assert top.columns == ["release_year", "track_id", "name", "energy"]
    assert rows(top) == Counter(TOP)
    assert pairs.columns == ["artist_id", "artist_name", "track_id", "track_name"]
    assert rows(pairs) == Counter(PAIRS)


def test_views(spark):
    tracks, artists = hand_tables(spark)
    check_views(
        views.track_summary(tracks, artists),
        views.most_energising_track_per_year(tracks),
        views.artist_track_summary(tracks, artists),
    )


def test_views_without_broadcast(spark, no_broadcast):
    test_views(spark)


def test_named_views(spark):
    tracks, artists = hand_tables(spark)
    for _ in range(2):
        views.create_views(spark, tracks, artists)
    names = [views.SUMMARY_VIEW, views.TOP_VIEW, views.PAIRS_VIEW]
    check_views(*[spark.table(n) for n in names])
    for n in names:
        spark.catalog.dropTempView(n)


def test_catalog_views(spark):
    tracks, artists = hand_tables(spark)
    tracks.write.mode("overwrite").saveAsTable("tracks")
    artists.write.mode("overwrite").saveAsTable("artists")
    for _ in range(2):
        views.create_catalog_views(spark)
    names = [views.SUMMARY_VIEW, views.TOP_VIEW, views.PAIRS_VIEW]
    check_views(*[spark.table(n) for n in names])
    for n in names:
        spark.sql(f"DROP VIEW {n}")
    views.create_views(spark)
    check_views(*[spark.table(n) for n in names])
    for n in names:
        spark.catalog.dropTempView(n)
    spark.sql("DROP TABLE tracks")
    spark.sql("DROP TABLE artists")


def test_top_k(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 3.0), (1, "c", 2.0), (2, "d", None), (2, "e", 9.0)],
        "g int, id string, m double",
    )
    got = top_per_group(df, "g", "m", ["id"], k=2, rank="place")
    assert rows(got) == Counter([
        (1, "b", 3.0, 1), (1, "c", 2.0, 2), (2, "d", None, 1), (2, "e", 9.0, 2)
    ])
    assert rows(top_per_group(df, "g", "m", ["id"], k=10**6)) == rows(df)
    with pytest.raises(ValueError):
        top_per_group(df, "g", "m", ["id"], k=0)


def test_typed_projection(spark):
    df = spark.createDataFrame(
        [("1", "Test", "abc", "12.7", "TRUE", "0.5", "['a','b']"),
         ("2", "", "", "", "", "", "")],
        "id string, name string, extra string, popularity string, explicit string, "
        "energy string, id_artists string",
    )
    out = typed_projection(df)
    assert out.dtypes == [
        ("id", "string"), ("name", "string"), ("extra", "string"), ("popularity", "int"),
        ("explicit", "boolean"), ("energy", "double"), ("id_artists", "array<string>"),
    ]
    first, second = out.orderBy("id").collect()
    assert tuple(first) == ("1", "Test", "abc", 12, True, 0.5, ["a", "b"])
    assert tuple(second) == ("2", None, None, None, None, None, None)


def test_required_columns():
    require_columns(["id", "name", "x"], "t")
    with pytest.raises(ValueError, match='Missing required CSV headers for table "t": name'):
        require_columns(["id", "x"], "t")


# --- one key with a third of the rows -------------------------------------


def skewed_tables(spark):
    """A third of the items are by one entity, a third of those are copies, and
    a sixth of all items have no list."""
    n = F.col("id")
    tracks = spark.range(9_000).select(
        F.when(n % 9 == 0, "copy").otherwise(n.cast("string")).alias("id"),
        F.when(n % 9 == 0, "copy").otherwise(F.concat(F.lit("n"), n)).alias("name"),
        F.lit(1).alias("popularity"),
        F.lit(0.5).alias("energy"),
        F.lit("Low").alias("danceability_level"),
        F.when(n % 3 == 0, F.array(F.lit("hot"), (n % 7).cast("string")))
        .when(n % 6 == 1, F.lit(None))
        .otherwise(F.array((n % 1000).cast("string")))
        .alias("id_artists"),
        F.when(n % 3 == 0, 2000).otherwise(n % 50).cast("int").alias("release_year"),
    )
    artists = spark.range(600).select(
        F.when(n % 3 == 0, "hot").otherwise(n.cast("string")).alias("id"),
        F.concat(F.lit("a"), n % 4).alias("name"),
        (n % 5).cast("int").alias("followers"),
    )
    return tracks, artists


def test_skewed_views_equal_plain_ones(spark):
    tracks, artists = skewed_tables(spark)
    plain = [
        rows(views.track_summary(tracks, artists)),
        rows(views.artist_track_summary(tracks, artists)),
    ]
    # Brute force over the same rows, without any join.
    followers, named = Counter(), {}
    for a in artists.collect():
        followers[a["id"]] += a["followers"]
        if a["followers"] > 0:
            named.setdefault(a["id"], Counter())[a["name"]] += 1
    sums, pairs = Counter(), Counter()
    for t in tracks.collect():
        key = tuple(t[c] for c in ("id", "name", "popularity", "energy", "danceability_level"))
        sums[key] += sum(followers[m] for m in t["id_artists"] or [])
        for m in t["id_artists"] or []:
            for name, times in named.get(m, {}).items():
                pairs[(m, name, t["id"], t["name"])] += times
    assert {k[:5]: k[5] for k in plain[0]} == dict(sums)
    assert plain[1] == pairs

    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert rows(views.track_summary(tracks, artists)) == plain[0]
        assert rows(views.artist_track_summary(tracks, artists)) == plain[1]
    finally:
        spark.conf.set(key, old)


def test_views_are_lazy_and_scan_the_items_once(spark, tmp_path, no_broadcast):
    tracks, artists = skewed_tables(spark)
    tracks.write.parquet(str(tmp_path / "t"))
    artists.write.parquet(str(tmp_path / "a"))
    stored = [spark.read.parquet(str(tmp_path / name)) for name in ("t", "a")]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("defining", "views")
    made = [views.track_summary(*stored), views.artist_track_summary(*stored)]
    made.append(views.most_energising_track_per_year(stored[0]))
    assert list(tracker.getJobIdsForGroup("defining")) == []
    spark.sparkContext.setJobGroup("running", "views")
    for df in made:
        files = df._jdf.queryExecution().executedPlan().toString()
        assert files.count(f"{tmp_path}/t") == 1


@pytest.fixture()
def eager_skew(spark, no_broadcast):
    """Adaptive execution that takes small partitions for skewed ones."""
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    got = rows(df)
    return got, df._jdf.queryExecution().executedPlan().toString()


def test_salted_join(spark, no_broadcast):
    left = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise((F.col("id") % 90).cast("string")).alias("k"), F.col("id").alias("n"),
    )
    right = spark.range(120).select(
        F.when(F.col("id") < 3, "hot").otherwise((F.col("id") % 60).cast("string")).alias("k"),
        F.col("id").alias("m"),
    )
    for how in ("inner", "left", "left_semi"):
        got = joins.salted_join(left, right, "k", how)
        plain = left.join(right, "k", how)
        assert got.columns == plain.columns and rows(got) == rows(plain)


def test_stored_views_on_skewed_tables(spark, eager_skew):
    tracks, artists = skewed_tables(spark)
    tracks.repartition(16).write.mode("overwrite").saveAsTable("tracks")
    artists.write.mode("overwrite").saveAsTable("artists")
    views.create_catalog_views(spark)
    expected = rows(views.track_summary(tracks, artists))
    got, plan = final_plan(spark.table(views.SUMMARY_VIEW))
    assert got == expected
    assert "skew=true" in plan
    for n in (views.SUMMARY_VIEW, views.TOP_VIEW, views.PAIRS_VIEW):
        spark.sql(f"DROP VIEW {n}")
    spark.sql("DROP TABLE tracks")
    spark.sql("DROP TABLE artists")


def test_skewed_prune(spark, no_broadcast):
    _, artists = skewed_tables(spark)
    some = spark.range(400).select(F.col("id").cast("string").alias("id"))
    for ids in (some, some.union(spark.createDataFrame([("hot",)], "id string"))):
        wanted = {r["id"] for r in ids.collect()}
        expected = Counter(tuple(r) for r in artists.collect() if r["id"] in wanted)
        assert rows(prepare.prune_entities(artists, ids)) == expected


def test_skewed_top(spark):
    tracks, _ = skewed_tables(spark)
    top = views.most_energising_track_per_year(tracks)
    plan = top._jdf.queryExecution().executedPlan().toString()
    # Merged before the only shuffle, which gets a row for each year and task.
    assert "Window" not in plan and plan.count("Exchange") == 1 and "partial_min_by" in plan
    best = {}
    for t in tracks.collect():
        year, pair = t["release_year"], (t["id"], t["name"])
        best[year] = min(best.get(year, pair), pair)
    assert {r["release_year"]: (r["track_id"], r["name"]) for r in top.collect()} == best


def test_top_of_any_type_matches_a_window(spark):
    nan = float("nan")
    data = [
        (g, f"n{i % 5}" if i % 4 else None, m, i % 3 - 1, "x")
        for i, (g, m) in enumerate(
            [(1, nan), (1, 5.0), (2, None), (2, nan), (3, -0.0), (3, 0.0), (4, -9.0), (None, 1.0), (None, 2.0)] * 7
        )
    ]
    df = spark.createDataFrame(data, "g int, id string, d double, n int, rank string").repartition(5)
    df = df.selectExpr(
        "*", "cast(d AS float) AS f", "if(n < 0, -9223372036854775808, n) AS l",
        "cast(n AS decimal(9,2)) AS c", "cast(n AS string) AS s", "date_add(date '2020-01-01', n) AS day",
    )
    from pyspark.sql import Window

    for measure in ("d", "f", "n", "l", "c", "s", "day"):
        order = [F.desc_nulls_first(measure), F.asc_nulls_last("id"), F.asc_nulls_last("l")]
        numbered = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
        expected = rows(numbered.where("r = 1").select("g", "id", measure))
        got = top_per_group(df, "g", measure, ["id", "l"])
        assert got.columns == df.columns
        assert str(sorted(rows(got.select("g", "id", measure)), key=repr)) == str(sorted(expected, key=repr))
        assert {r["place"] for r in top_per_group(df, "g", measure, ["id"], rank="place").collect()} == {1}


def test_hot_keys_are_measured_and_only_they_are_spread(spark, no_broadcast):
    left = spark.range(9_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL WHEN id % 7 = 0 THEN 'it\\'s {x}' "
        "ELSE cast(id AS string) END AS k", "id AS salt",
    )
    hot = joins.hot_keys(left, "k")
    assert sorted(hot) == ["hot", "it's {x}"]
    assert joins.hot_keys(left.where("false"), "k") == []
    right = spark.range(900).selectExpr("CASE WHEN id < 5 THEN 'hot' ELSE cast(id AS string) END AS k", "id AS m")
    for how in ("inner", "left", "left_semi"):
        got = joins.salted_join(left, right, "k", how, hot=hot)
        plain = left.join(right, "k", how)
        assert got.columns == plain.columns and rows(got) == rows(plain)


def test_views_with_hot_ids_equal_plain_ones(spark, no_broadcast):
    tracks, artists = skewed_tables(spark)
    hot = views.hot_members(tracks)
    assert "hot" in hot and len(hot) < 10
    for view in (views.track_summary, views.artist_track_summary):
        assert rows(view(tracks, artists, hot)) == rows(view(tracks, artists))


def test_bloom_filter_passes_all_its_ids_and_few_others(spark):
    from refrain.operators.bloom import bloom_filter, probable

    ids = spark.range(0, 20_000, 2).selectExpr("concat('é', id) AS id").union(spark.sql("SELECT NULL"))
    asked = spark.range(20_000).selectExpr("id AS word", "concat('é', id) AS id")
    got = probable(asked, "id", bloom_filter(ids, 4_000), 4_000)
    assert got.columns == asked.columns
    passed = {r.word for r in got.collect()}
    assert passed >= set(range(0, 20_000, 2)) and len(passed) < 10_500
    nothing = bloom_filter(ids.where("false"))
    assert probable(asked, "id", nothing).isEmpty()
    nulls = asked.selectExpr("cast(NULL AS string) AS id")
    assert prepare.prune_entities(nulls, ids, sieve=bloom_filter(ids)).isEmpty()


def test_pruning_shuffles_only_probable_entities(spark, no_broadcast):
    from refrain.operators.bloom import bloom_filter

    entities = spark.range(5_000).selectExpr("cast(id AS string) AS id", "id % 3 AS salt")
    ids = spark.range(0, 300, 3).selectExpr("cast(id AS string) AS id")
    pruned = prepare.prune_entities(entities, ids, sieve=bloom_filter(ids))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    # The filter is asked below the exchange of the exact join.
    assert plan.index("SortMergeJoin") < plan.index("Exchange") < plan.index("BroadcastHashJoin")
    assert rows(pruned) == rows(entities.where("id < 300 AND id % 3 = 0"))


def test_columns_with_names_of_helpers(spark):
    names = ["number", "failed", "date", "form", "salt", "rank", "part", "ids", "kind"]
    values = ", ".join(f"'{n}' AS {n}" for n in names)
    df = spark.sql(
        f"""SELECT 'a' AS id, 'n' AS name, '70000' AS duration_ms, "['x']" AS id_artists,
        '2020-01-02' AS release_date, '0.9' AS danceability, {values}"""
    )
    for made in (prepare.prepare_items(df), prepare.classify_items(df), prepare.rejected_items(df),
                 prepare.prune_entities(df, df.select("id")), top_per_group(df, "id", "name", ["id"], 3)):
        for row in made.collect():
            assert all(row[n] == n for n in names)
    assert prepare.prepare_items(df).first()["release_month"] == "01"


def test_left_rows_without_a_key_are_spread(spark, no_broadcast):
    left = spark.range(4_000).select(F.when(F.col("id") < 0, "hot").alias("k"), F.col("id").alias("n"))
    right = spark.createDataFrame([("hot", 1)], "k string, m int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_join(left, right, "k", "left", hot=["hot"])
        assert joined.count() == 4_000
        assert joined.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("hot", [(), ("7",)])
def test_items_without_members_make_no_skewed_partition(spark, eager_skew, hot):
    columns = "cast(id AS string) AS id, 'n' AS name, 1 AS popularity, 0.5D AS energy, 'Low' AS danceability_level"
    listed = "if(id < 4000, cast(NULL AS array<string>), array(cast(id AS string))) AS id_artists"
    items = spark.range(5_000).selectExpr(*columns.split(", "), listed)
    entities = spark.range(5_000).selectExpr("cast(id AS string) AS id", "cast(id AS int) AS followers")
    got, plan = final_plan(views.track_summary(items, entities, hot))
    assert sum(got.values()) == 5_000
    assert "skew=true" not in plan
