"""Small worked examples with answers derived by hand."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import hashing, text, times, udfs
from tidemark.operators import alerts, joins, patterns, rolling, topn, transforms, windows
from tidemark.sources.tables import as_table, from_rows, register

BASE = 1_600_000_000


def tuples(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def timed(spark, rows, schema):
    """Literal rows whose last column is epoch seconds."""
    df = from_rows(spark, rows, f"{schema}, s long")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


def test_rolling_sum_keeps_first_row_fields(spark):
    df = from_rows(spark, [(1, 2, 2), (2, 3, 1), (2, 2, 4), (1, 5, 3)], "a int, b int, c int")
    out = rolling.rolling(df, ["a"], ["arrival"], "b", "sum").orderBy("arrival")
    assert [tuple(r) for r in out.select("a", "b", "c").collect()] == [
        (1, 2, 2), (2, 3, 1), (2, 5, 1), (1, 7, 2),
    ]


def test_rolling_concat(spark):
    df = from_rows(
        spark, [("en", ["tea"]), ("fr", ["vin"]), ("en", ["cake"])], "k string, w array<string>"
    )
    out = rolling.rolling_concat(df, ["k"], ["arrival"], "w").orderBy("arrival")
    assert [r["w"] for r in out.collect()] == [["tea"], ["vin"], ["tea", "cake"]]


def test_row_wise(spark):
    pairs = from_rows(spark, [("north", 17), ("south", 9)], "n string, v int")
    assert tuples(pairs.filter(F.col("v") > 10), "n", "v") == [("north", 17)]
    colors = from_rows(spark, [("white",), ("black",), ("gray",)], "c string", arrival=None)
    copies = F.when(F.col("c") == "white", 1).when(F.col("c") == "black", 2)
    assert tuples(transforms.repeat_rows(colors, copies), "c") == [
        ("black",), ("black",), ("white",)
    ]


def test_route_first_match_wins(spark):
    df = from_rows(spark, [(1001,), (999,), (1000,), (None,)], "v int", arrival=None)
    out = transforms.route(df, {"large": F.col("v") > 1000, "small": F.lit(True)})
    assert tuples(out["large"], "v") == [(1001,)]
    assert {r["v"] for r in out["small"].collect()} == {999, 1000, None}
    tagged = transforms.tag_branch(df, {"large": F.col("v") > 1000, "any": F.col("v") > 0})
    assert {(r["v"], r["branch"]) for r in tagged.collect()} == {
        (1001, "large"), (999, "any"), (1000, "any"), (None, None)
    }


def test_not_equal_and_nulls(spark):
    df = from_rows(spark, [("x",), ("y",), (None,)], "b string", arrival=None)
    assert df.filter(transforms.not_equal("b", "x")).count() == 1
    assert df.filter(transforms.not_equal("b", "x", keep_nulls=True)).count() == 2


def test_connect_drops_sentinel(spark):
    first = from_rows(spark, [(1, "elm"), (2, "oak")], "k int, w string")
    second = from_rows(spark, [(1, "ivy"), (2, "ivy")], "k int, w string")

    def side(label):
        return lambda df: df.filter("w <> 'ivy'").select(
            F.concat(F.lit(label), "w").alias("w"), "k"
        )

    out = transforms.connect(first, second, side("1:"), side("2:"))
    assert tuples(out, "w", "k") == [("1:elm", 1), ("1:oak", 2)]


def test_union_and_lifecycle(spark):
    one, two, three = (from_rows(spark, [(i,)], "v int", arrival=None) for i in (1, 2, 3))
    both = transforms.union_all(one, two, three, one)
    assert tuples(both, "v") == [(1,), (1,), (2,), (3,)]
    out = transforms.map_with_lifecycle(
        both, "v int", lambda: 1, lambda one, b: b + one, lambda one: None
    )
    assert tuples(out, "v") == [(2,), (2,), (3,), (4,)]
    assert "task" in transforms.with_task_index(both).columns


def test_freezing_is_strict(spark):
    df = from_rows(spark, [("a", 32.0), ("b", 31.9)], "id string, t double")
    main, side = transforms.with_side_output(df, F.col("t") < 32.0, {"id": F.col("id")})
    assert main.count() == 2 and tuples(side, "id") == [("b",)]


def test_min_max_row_and_changes(spark):
    df = from_rows(spark, [(1, -2), (1, 2)], "k int, v int")
    assert tuples(windows.min_max_row(df, "k", "v"), "k", "range.lo", "range.hi") == [(1, -2, 2)]
    log = rolling.changelog(
        df, ["k"], ["arrival"], [("lo", "min", F.col("v")), ("hi", "max", F.col("v"))]
    ).orderBy("arrival", "is_add")
    assert [tuple(r) for r in log.select("is_add", "lo", "hi").collect()] == [
        (True, -2, -2), (False, -2, -2), (True, -2, 2),
    ]


def test_top_two(spark):
    df = from_rows(spark, [(1, v) for v in (-1, 2, 0, 5, 4)] + [(2, 5), (2, 5)], "k int, v int")
    out = topn.top_values(df, "k", "v", 2, ["arrival"])
    assert tuples(out, "k", "v", "rank") == [(1, 4, 2), (1, 5, 1), (2, 5, 1), (2, 5, 2)]
    low = from_rows(spark, [(1, -3_000_000_000), (1, None), (1, -(1 << 31)), (1, -(1 << 63))], "k int, v long")
    out = topn.top_values(low, "k", "v", 2, ["arrival"])
    assert tuples(out, "v", "rank") == [(-3_000_000_000, 2), (-(1 << 31), 1)]
    halves = from_rows(spark, [(1, -0.5), (1, -1.5), (1, -1.25)], "k int, v double")
    assert tuples(topn.top_values(halves, "k", "v", 1, ["arrival"]), "v") == [(-0.5,)]


def test_report(spark):
    df = spark.createDataFrame([(9, 1, 7, 3), (9, 2, 5, 1)], "window_end int, rank int, item int, n int")
    out = topn.report(df, topn.count_line("rank", "item", "item", "n"), header=F.lit("top"))
    assert out.first()["report"] == "top\nNo.1 item=7 count=3\nNo.2 item=5 count=1"


@pytest.mark.parametrize(
    "line,parts",
    [("hello#world", ["hello", "world"]), ("a#b##", ["a", "b"]), ("##", []),
     ("", [""]), ("#a##b", ["", "a", "", "b"])],
)
def test_split_drops_trailing_empties(spark, line, parts):
    df = from_rows(spark, [(line,)], "s string", arrival=None)
    out = text.words_with_length(df, "s", "#")
    assert [(r["word"], r["length"]) for r in out.collect()] == [(p, len(p)) for p in parts]
    udfs.register_splitter(spark, "t_split", "#")
    register(df, "t_lines")
    sql = spark.sql("SELECT word, length FROM t_lines, LATERAL t_split(s)")
    assert [tuple(r) for r in sql.collect()] == [(p, len(p)) for p in parts]


def java_hash(s, seed, bits):
    raw, h = s.encode("utf-16-be"), 0
    for i in range(0, len(raw), 2):
        h = (h * seed + (raw[i] << 8 | raw[i + 1])) & 0xFFFFFFFF
    return h & (bits - 1)


def test_hashes(spark):
    words = ["Customer#000000001", "9876543210", "", "naïve 中文", "a😀b", "x" * 300]
    df = from_rows(spark, [(w,) for w in words] + [(None,)], "s string")
    s = F.col("s")
    udfs.register_string_hash(spark, "t_hash", -7)
    register(df, "t_words")
    out = df.select(
        "s", hashing.string_hash(s).alias("h"), hashing.string_hash(s, -7).alias("h7"),
        hashing.bit_offset(s).alias("bit"), F.expr("t_hash(s)").alias("sql"),
    ).collect()

    def signed(v):
        v &= 0xFFFFFFFF
        return v - (1 << 32) if v >= 1 << 31 else v

    for r in out:
        if r["s"] is None:
            assert r["h"] is None and r["bit"] is None and r["sql"] is None
            continue
        full = java_hash(r["s"], 31, 1 << 32)
        assert (r["h"], r["h7"], r["sql"]) == (signed(full), signed(full * -7), signed(full * -7))
        assert r["bit"] == java_hash(r["s"], 61, 1 << 29)
    known = {r["s"]: r for r in out}
    assert known["Customer#000000001"]["h"] == 478928364
    assert known["9876543210"]["bit"] == 427874809


def test_times(spark):
    row = spark.range(1).select(
        times.seconds(F.lit("1558430842")).alias("a"), times.seconds(F.lit("x")).alias("b"),
        times.to_text(times.from_millis(F.lit(1500))).alias("c"),
    ).first()
    assert row["a"].year == 2019 and row["b"] is None and row["c"] == "1970-01-01 00:00:01.500"
    assert times.micros("5 seconds") == 5_000_000 and times.micros("1 day") == 86_400_000_000


def fails(name):
    return (name, F.col("kind") == "fail")


def test_login_pattern(spark):
    df = timed(
        spark,
        [("1", "192.168.0.1", "fail", BASE + 842), ("1", "192.168.0.2", "fail", BASE + 843),
         ("1", "192.168.0.3", "fail", BASE + 844), ("2", "192.168.10.10", "success", BASE + 845)],
        "u string, ip string, kind string",
    )
    out = patterns.match_sequence(
        df, "u", ["ts", "arrival"], [fails("a"), fails("b"), fails("c")], within="10 seconds"
    )
    assert tuples(out, "a.ip", "b.ip", "c.ip") == [("192.168.0.1", "192.168.0.2", "192.168.0.3")]


def test_overlapping_matches_and_failure_counter(spark):
    df = timed(spark, [("1", "fail", t) for t in (1, 2, 3, 4)], "u string, kind string")
    out = patterns.match_sequence(
        df, "u", ["ts", "arrival"], [fails("a"), fails("b"), fails("c")], within="5 seconds"
    )
    sec = [F.unix_seconds(f"{n}.ts") for n in "abc"]
    assert tuples(out, *sec) == [(1, 2, 3), (2, 3, 4)]
    alert = alerts.repeated_failures(
        df, "u", ["ts", "arrival"], F.col("kind") == "fail", F.col("kind") == "success",
        "5 seconds",
    )
    assert tuples(alert, F.unix_seconds("fires_at"), "n") == [(6, 4)]


def order_rows(spark, rows):
    return timed(spark, [(o, k, BASE + s) for o, k, s in rows], "o string, kind string")


def attempts(df):
    steps = [("create", F.col("kind") == "create"), ("pay", F.col("kind") == "pay")]
    out = patterns.match_sequence(
        df, "o", ["ts", "arrival"], steps, within="5 seconds", on_timeout=True
    )
    return tuples(out, "o", "outcome", F.unix_seconds("create.ts") - BASE)


def test_order_timeout(spark):
    df = order_rows(spark, [("1", "create", 842), ("2", "create", 843), ("2", "pay", 844),
                            ("3", "pay", 942), ("4", "pay", 943)])
    assert attempts(df) == [("1", "timeout", 842), ("2", "matched", 843)]
    out = alerts.order_timeouts(
        df, "o", ["ts", "arrival"], F.col("kind") == "create", "5 seconds"
    )
    assert tuples(out, "o", "kind") == [("1", "create")]
    alone = joins.without_partner(
        df.filter("kind = 'create'"), df.filter("kind = 'pay'"), "o", "ts", "5 seconds"
    )
    assert tuples(alone, "o") == [("1",)]


def test_order_timeout_boundaries(spark):
    exact = order_rows(spark, [("1", "create", 10), ("1", "pay", 15)])
    assert attempts(exact) == [("1", "timeout", 10)]
    created = F.col("kind") == "create"
    assert alerts.order_timeouts(exact, "o", ["ts", "arrival"], created, "5 seconds").count() == 0
    twice = order_rows(spark, [("1", "create", 10), ("1", "create", 11), ("1", "pay", 12)])
    assert attempts(twice) == [("1", "matched", 11)]


def test_reconciliation(spark):
    orders = order_rows(spark, [("1", "create", 842), ("2", "create", 843), ("1", "pay", 844),
                                ("2", "pay", 845), ("3", "create", 849), ("3", "pay", 849)])
    pays = order_rows(spark, [("1", "w", 847), ("2", "z", 848), ("4", "z", 850)])

    def run(left):
        out = joins.reconcile(
            left.withColumn("ord", F.col("arrival")),
            pays.withColumn("ord", F.col("arrival") + 100), "o", ["ord"],
        )
        shown = out.filter("not superseded")
        return tuples(shown, "side", "o", F.unix_seconds("first.ts") - BASE)

    assert run(orders.filter("kind = 'create'")) == [
        ("matched", "1", 842), ("matched", "2", 843), ("order", "3", 849), ("pay", "4", 850),
    ]
    assert run(orders) == [
        ("matched", "1", 844), ("matched", "2", 845), ("order", "3", 849), ("pay", "4", 850),
    ]


def test_gate(spark):
    readings = timed(spark, [(f"sensor_{i}", t) for i in (1, 2, 7) for t in (99, 100, 104, 105, 110)],
                     "id string")
    switches = from_rows(spark, [("sensor_2", 5_000_000), ("sensor_7", 10_000_000)],
                         "id string, len long").withColumn("ts", F.timestamp_seconds(F.lit(100)))
    out = joins.gate(readings, switches, "id", "ts", "len")
    assert tuples(out, "id", F.unix_seconds("ts")) == [
        ("sensor_2", 100), ("sensor_2", 104),
        ("sensor_7", 100), ("sensor_7", 104), ("sensor_7", 105),
    ]


def test_jump_first_row_rules(spark):
    df = timed(spark, [("a", 40.0, 1), ("a", 41.0, 2)], "id string, v double")
    args = (df, ["id"], ["ts", "arrival"], "v", 1.7)
    assert tuples(rolling.jumps(*args, first_is_zero=True), "v") == [(40.0,)]
    assert rolling.jumps(*args, first_is_zero=False).count() == 0


def test_rising_run(spark):
    df = timed(
        spark,
        [("equal", 1.0, 1), ("equal", 2.0, 2), ("equal", 2.0, 3), ("equal", 2.0, 9),
         ("drop", 1.0, 1), ("drop", 2.0, 2), ("drop", 1.0, 3)],
        "id string, v double",
    )
    out = alerts.rising_runs(df, "id", ["ts", "arrival"], "v", "1 second")
    assert tuples(out, "id", F.unix_seconds("fires_at")) == [("equal", 3)]


def test_tumbling_window_is_half_open(spark):
    df = timed(spark, [("a", t) for t in (1, 2, 3, 4, 5)], "k string")
    assert tuples(windows.count(df, "ts", "5 seconds", ["k"]), "window_end", "n") == [
        (5000, 4), (10000, 1)
    ]


def test_sliding_totals(spark):
    df = timed(spark, [("a", t) for t in range(0, 100, 7)], "k string")
    panes = windows.sliding_count(df, "ts", "60 seconds", "5 seconds", ["k"])
    plain = windows.count(df, "ts", "60 seconds", ["k"], slide="5 seconds")
    cols = ("k", "window_end", "n")
    assert tuples(panes, *cols) == tuples(plain, *cols)
    assert panes.agg(F.sum("n")).first()[0] == 12 * df.count()


def test_early_counts(spark):
    df = timed(spark, [("a", t) for t in (1, 1, 4)], "k string")
    out = windows.early_counts(df, "ts", "6 seconds", "1 second", ["k"])
    assert tuples(out, "fire_at", "n") == [(2000, 2), (3000, 2), (4000, 2), (5000, 3), (6000, 3)]


def test_timers(spark):
    df = timed(spark, [("a", 1), ("a", 1), ("b", 1), ("a", 2)], "k string")
    out = alerts.timers(df, "k", "ts", "5 seconds")
    assert tuples(out, "k", F.unix_seconds("fires_at")) == [("a", 6), ("a", 7), ("b", 6)]


def test_table_from_stream_columns(spark):
    df = timed(spark, [("a", 1.5, 1)], "id string, t double")
    out = as_table(df, {"name": "id", "at": F.col("ts")}, event_time="at")
    assert out.columns == ["name", "at"]
    register(out, "t_table")
    assert spark.sql("SELECT count(*) FROM t_table WHERE name = 'a'").first()[0] == 1
