"""Sources, streams and operators on small tables whose results are known."""

import datetime
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import scalars as S
from millrace.operators import aggregates, matching, quality, rules, snapshots, views
from millrace.sources import files, pages
from millrace.streaming import jobs

ROW = StructType().add("id", "long").add("name", "string").add("change_status", "string")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_strict_lines_skip_comments_and_fail_on_what_does_not_parse(spark, tmp_path):
    (tmp_path / "good").write_text('# a comment\n\n{"id": 1, "name": "a"}\n   \n{"id": 2}\n')
    assert [(r.id, r.name) for r in files.strict_jsonl(spark, str(tmp_path / "good"), ROW).orderBy("id").collect()] == [(1, "a"), (2, None)]
    (tmp_path / "bad").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        files.strict_jsonl(spark, str(tmp_path / "bad"), ROW).collect()


def test_tolerant_lines_drop_what_does_not_parse_and_what_is_gone(spark, tmp_path):
    (tmp_path / "rows").write_text('{"id": 1, "change_status": "SAME"}\nnot json\n{"id": 2, "change_status": "DISAPPEARED"}\n{"id": 3}\n')
    rows = files.tolerant_jsonl(spark, str(tmp_path / "rows"), ROW, "change_status", ("DISAPPEARED",))
    assert sorted(r.id for r in rows.collect()) == [1, 3]
    none = files.tolerant_jsonl(spark, str(tmp_path / "nowhere"), ROW, missing_ok=True)
    assert none.count() == 0 and none.schema == ROW
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.tolerant_jsonl(spark, str(tmp_path / "nowhere"), ROW).count()


def test_csv_is_stripped_and_export_is_read_back(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,name,change_status\n 1 ,  Ann ,\n2,"a, ""b""",NEW\n')
    rows = files.csv(spark, str(tmp_path / "in.csv"), ROW)
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [(1, "Ann", None), (2, 'a, "b"', "NEW")]
    files.write_export(rows, str(tmp_path / "dated"), str(tmp_path / "latest"), columns=["name", "id"])
    for out in ("dated", "latest"):
        back = spark.read.options(header=True, quote='"', escape='"').csv(str(tmp_path / out))
        assert back.columns == ["name", "id"] and back.count() == 2
    files.write_partitioned(rows, str(tmp_path / "parts"), ["id"])
    assert (tmp_path / "parts" / "id=1").exists() and spark.read.parquet(str(tmp_path / "parts")).count() == 2


def test_columns_that_may_be_missing(spark):
    df = spark.createDataFrame([(1, " ", "x; y ;;"), (2, "b", None)], "id int, a string, names string")
    assert [r.x for r in df.select(files.first_present(df, "none", "a", "id").alias("x")).collect()] == ["1", "b"]
    assert files.filled(df, {"a": "z", "c": "new"}).where("c = 'new' and a = ' '").count() == 1
    got = df.select(files.role_parties({"names": "owner", "a": "other"}).alias("p")).collect()
    assert [[tuple(p) for p in r.p] for r in got] == [[("x", "owner"), ("y", "owner")], [("b", "other")]]


def test_text_is_split_before_headings(spark):
    df = spark.createDataFrame([(1, "intro\nNOTICE a first one\nNOTICE b"), (2, None)], "id int, body string")
    got = files.blocks_of(df, "body", "NOTICE", least=6).orderBy("place").collect()
    assert [(r.id, r.block) for r in got] == [(1, "NOTICE a first one"), (1, "NOTICE b")]


def test_paged_source_reads_all_pages_retries_and_reports_errors(spark, tmp_path):
    folder = str(tmp_path)
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(json.dumps({"rows": [[i, f"r{i}"], [i + 10, "s"]]}))

    def fetch(page):
        import os

        path, mark = f"{folder}/{page}.json", f"{folder}/tried{page}"
        if not os.path.exists(path):
            return None
        if page == 3 and not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("once")
        with open(path) as f:
            return f.read()

    pages.register(spark, pages.paged("captured_pages", "id int, name string", fetch))
    rows = spark.read.format("captured_pages").option("pages", "8").option("per_partition", "2").load()
    assert Counter(r.id for r in rows.collect()) == Counter([*range(5), *range(10, 15)])
    (tmp_path / "2.json").write_text('{"error": "no such layer"}')
    with pytest.raises(Exception, match="no such layer"):
        rows.collect()


EVENTS = "event_id long, user_id long, kind string, ts timestamp, value long"


def events(spark, n=60):
    at = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(i, i % 5, "ab"[i % 2], at + datetime.timedelta(minutes=7 * i), i * i % 17) for i in range(n)], EVENTS)


@pytest.fixture
def landed(spark, tmp_path):
    rows = events(spark)
    for part in range(3):
        rows.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return rows, lambda files=None: jobs.source(spark, str(tmp_path / "in"), rows.schema, files), tmp_path


def test_windowed_stream_is_its_batch_form(spark, landed):
    rows, stream, at = landed
    counts = jobs.windowed_counts(stream(1), ["kind"], "ts", "1 hour", "30 days")
    got = jobs.run_to_end(counts, "counts", str(at / "cp1"))
    want = rows.groupBy(F.window("ts", "1 hour").alias("w"), "kind").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "kind", "n")
    assert quality.difference(got, want).count() == 0
    sliding = jobs.run_to_end(jobs.windowed_counts(stream(), [], "ts", "1 hour", "30 days", "30 minutes"), "sliding", str(at / "cp2"))
    assert sum(r.n for r in sliding.collect()) == 2 * rows.count()


def test_sessions_and_deduplication_of_a_stream(spark, landed):
    rows, stream, at = landed
    found = jobs.run_to_end(jobs.sessions(stream(), ["user_id"], "ts", "40 minutes", "30 days"), "sessions", str(at / "cp"))
    assert found.count() == 5 and sum(r.n for r in found.collect()) == 60  # a user's events are 35 minutes apart
    twice = stream().union(stream())
    once = jobs.run_to_end(jobs.deduplicated(twice, ["event_id"], "ts", "30 days"), "once", str(at / "cp3"), "append")
    assert sorted(r.event_id for r in once.collect()) == list(range(60))


def test_state_of_a_stream_is_the_upsert_of_its_batches(spark, landed):
    rows, stream, at = landed
    kept = jobs.keep_state(stream(1), str(at / "state"), str(at / "cp"), "user_id", "value", "event_id", "2024-02-01", 4)
    assert kept.manifest(spark, 3) is None
    got = kept.read(spark, 2)
    assert got.count() == 5 and {str(r.first_seen) for r in got.collect()} == {"2024-02-01"}


def test_groups_without_a_key_are_told_apart_and_blank_instruments_count_each(spark):
    df = spark.createDataFrame([(1, "a", "i", "2024-01-01"), (1, "a", "i", "2024-01-03"), (1, "a", " ", "2024-01-02"), (1, "a", None, None), (None, "p", "i", None), (None, "q", "i", None)], "k int, f string, ins string, d string")
    got = aggregates.merge_groups(aggregates.with_group_key(df, "k", ["f"]), ["key_missing", "group_key"], "ins", ["f"], "d").collect()
    assert {(r.key_missing, r.group_key, r.n, r.earliest, r.latest) for r in got} == {(False, "1", 3, "2024-01-01", "2024-01-03"), (True, "p", 1, None, None), (True, "q", 1, None, None)}


def test_diff_labels_every_key_and_nulls_are_equal(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "x"), (5, "e")], "k int, v string")
    got = {r.k: (r.v, r.change_status) for r in snapshots.diff(old, new, ["k"], ["v"]).collect()}
    assert got == {1: ("a", "SAME"), 2: (None, "SAME"), 3: ("x", "UPDATED"), 4: ("d", "GONE"), 5: ("e", "NEW")}
    assert {r.k: r.v for r in snapshots.merge(old, new, ["k"]).collect()} == {1: "a", 2: None, 3: "x", 4: "d", 5: "e"}


def test_upsert_keeps_the_first_date_and_repeats_within_a_batch_update_each_other(spark):
    day = datetime.date(2024, 1, 1)
    state = spark.createDataFrame([("a", day, day, 10, None, None), ("z", day, day, 1, None, None)], "k string, first_seen date, last_seen date, current int, previous int, delta int")
    batch = spark.createDataFrame([("a", 15, 1), ("b", 5, 2), ("b", 9, 3)], "k string, v int, o int")
    got = {r.k: (str(r.first_seen), str(r.last_seen), r.current, r.previous, r.delta) for r in snapshots.upsert(state, batch, "k", "v", F.lit("2024-02-01").cast("date"), "o").collect()}
    assert got == {"a": ("2024-01-01", "2024-02-01", 15, 10, 5), "b": ("2024-02-01", "2024-02-01", 9, 5, 4), "z": ("2024-01-01", "2024-01-01", 1, None, None)}


def test_picks_have_no_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "b"), ("n", None, "q"), (None, 2, "w")], "k string, s int, t string")
    assert {(r.k, r.s, r.t) for r in snapshots.best_per_key(df, "k", "s", "t").collect()} == {("a", 3, "b"), ("n", None, "q"), (None, 2, "w")}


def test_tiers_fall_through_and_several_candidates_are_ambiguous(spark):
    left = spark.createDataFrame([(1, "p", "u"), (2, "x", "u"), (3, None, None), (4, "s", "none")], "id int, a string, b string")
    right = spark.createDataFrame([(10, "p", "u"), (11, "q", "u"), (12, "s", None), (13, "s", None)], "rid int, a string, b string")
    got = {r.id: (r.tier, r.confidence, r.candidates, r.match_id) for r in matching.tiered_match(left, right, "id", "rid", [("both", 95, ["a", "b"]), ("a", 85, ["a"]), ("b", 40, ["b"])], ambiguous={"both": 60, "a": 60}).collect()}
    assert got == {1: ("both", 95, 1, 10), 2: ("b", 40, 2, 10), 3: (None, 0, 0, None), 4: ("a", 60, 2, 12)}


def test_first_definitive_strategy_wins_over_earlier_ambiguous_ones(spark):
    hits = [("a", 1, t) for t in range(3)] + [("a", 2, 7)] + [("b", 1, t) for t in range(9)] + [("c", 1, 1), ("c", 1, 2), ("c", 3, 5), ("c", 3, 6)]
    got = {r.k: (r.status, r.place, r.matches, r.match) for r in matching.resolve(spark.createDataFrame(hits, "k string, place int, t int"), "k", "place", "t").collect()}
    assert got == {"a": ("definitive", 2, 1, 7), "c": ("ambiguous", 1, 2, None)}


def test_parts_must_stand_in_order_without_overlap(spark):
    names = spark.createDataFrame([(1, "SMITH JOHN A"), (2, "JOHN SMITH"), (3, "SMITHJOHN"), (4, "100% SURE_X"), (5, None)], "n int, name string")
    asked = spark.createDataFrame([(1, "SMITH", "JOHN"), (2, "0%", "E_X"), (3, "THJ", "JOHN"), (4, None, "x")], "ask int, a string, b string")
    got = matching.ordered_contains(names, "name", asked, "ask", ["a", "b"])
    assert {(r.ask, r.n) for r in got.collect()} == {(1, 1), (1, 3), (2, 4)}


def test_contracts_and_the_gate(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    with pytest.raises(quality.ContractError, match="has x: 1 rows"):
        quality.require(df, {"has x": F.col("x").isNotNull()})
    assert quality.require(df, {"has y": F.col("y").isNotNull()}) is df
    no = {"none": F.col("y") == "zzz"}
    assert quality.verdict(quality.gate(df, no, no)) == "ok"
    assert quality.verdict(quality.gate(df, no, {"null x": F.col("x").isNull()}, ["later"])) == "review"
    assert quality.verdict(quality.gate(df, {"null x": F.col("x").isNull()}, no)) == "blocked"
    assert [(r.y, r.side) for r in quality.difference(df, df.where("x = 1")).collect()] == [("b", "left")]
    assert quality.duplicate_keys(df.union(df), ["y"]).count() == 2


def test_rules(spark):
    t, f, n = F.lit(True), F.lit(False), F.lit(None).cast("boolean")
    assert one(spark, rules.flags({"b": t, "a": t, "c": f, "d": n})) == ["a", "b"]
    assert one(spark, rules.ordered_paths([("p", f, True), ("q", t, False), ("q", t, False), ("stop", t, True), ("r", t, False)])) == ["q", "stop"]
    assert one(spark, rules.points({"a": (t, 9), "b": (t, 8), "c": (n, 50)}, most=12)) == 12.0
    assert [one(spark, rules.band(F.lit(v), [(80, "hi"), (50, "mid")], "low")) for v in (80, 79.9, None)] == ["hi", "mid", "low"]
    assert one(spark, rules.repeated(F.array(F.struct(F.lit(2).alias("c"), F.lit("x").alias("v")), F.struct(F.lit(1).alias("c"), F.lit("y").alias("v"))), "c", "v")) == ["x", "x", "y"]


@pytest.mark.parametrize(
    ("column", "want"),
    [
        (lambda: S.normalized_line(F.lit("  12  Main\tst., ")), "12 MAIN ST"),
        (lambda: S.leading_number(F.lit("12 - 14 Main")), "12-14"),
        (lambda: S.leading_number(F.lit("Main 12")), ""),
        (lambda: S.slug(F.lit("Notice of sale (2)")), "NOTICE_OF_SALE_2"),
        (lambda: S.label_of(F.lit("notice_of_sale")), "Notice Of Sale"),
        (lambda: S.to_number(F.lit("$1,234.50")), 1234.5),
        (lambda: S.to_number(F.lit("n/a")), None),
        (lambda: S.to_int(F.lit("-7.9")), -7),
        (lambda: S.iso_date(F.lit("2024-02-30T00:00")), None),
        (lambda: S.date_of(F.lit(" 3/9/2024 "), "M/d/yyyy", "MMMM d, yyyy"), datetime.date(2024, 3, 9)),
        (lambda: S.date_of(F.lit("March 9, 2024"), "M/d/yyyy", "MMMM d, yyyy"), datetime.date(2024, 3, 9)),
        (lambda: S.first_weekday(F.lit("2024-10-20").cast("date"), "Tue"), datetime.date(2024, 10, 1)),
        (lambda: S.off_days(F.lit("2024-12-25").cast("date"), ["12-25", "12-26"]), datetime.date(2024, 12, 27)),
        (lambda: S.business_day(F.lit("2024-06-01").cast("date")), datetime.date(2024, 6, 3)),
        (lambda: S.ratio_at_least(F.lit(None).cast("int"), F.lit(2), 1.5), False),
        (lambda: S.plain_text(F.lit("<p>a &lt; b</p><script>x<y</script> c&nbsp;d")), "a < b c d"),
        (lambda: S.labelled(F.lit("Buyer: ; Seller:  Ann Lee \nx"), ["Buyer", "Seller"]), "Ann Lee"),
        (lambda: views.joined(F.lit("a"), F.lit(" "), F.lit(None).cast("string"), F.lit("b")), "a, b"),
    ],
)
def test_scalars(spark, column, want):
    assert one(spark, column()) == want


def test_null_parts_of_an_id_count_as_empty(spark):
    a, b = F.lit("a"), F.lit(None).cast("string")
    assert one(spark, S.stable_id(a, b, a)) == one(spark, S.stable_id(a, F.lit(""), a)) != one(spark, S.stable_id(a, a))


def test_export_rows_are_flat(spark):
    df = spark.range(1).select(F.array(F.lit(1), F.lit(2)).alias("a"), F.struct(F.lit("x").alias("k")).alias("s"), F.lit(3).alias("n"))
    assert tuple(views.flat(df).first()) == ("1|2", '{"k":"x"}', 3)


def test_empty_tables_give_empty_results(spark):
    none = spark.createDataFrame([], "k int, v string, o int")
    assert snapshots.diff(none, none, ["k"], ["v"]).count() == 0
    assert snapshots.last_wins(none, ["k"], "o").count() == 0
    assert aggregates.histogram(none, "v").count() == 0
    assert matching.resolve(none.select("k", F.col("o").alias("place"), "v"), "k", "place", "v").count() == 0
    assert quality.violations(none, {"v": F.col("v").isNotNull()}).count() == 0


def test_arrays_of_json_and_paths_of_outputs(spark, tmp_path):
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("id long, name string")
    (tmp_path / "good.json").write_text('[{"id": 1, "name": "a"},\n {"id": 2}]')
    assert sorted(files.json_array(spark, str(tmp_path / "good.json"), schema, ("id",)).collect()) == [(1, "a"), (2, None)]
    for name, text in (("bad", '{"id": 1}'), ("odd", "[1]"), ("less", '[{"name": "x"}]')):
        (tmp_path / f"{name}.json").write_text(text)
        with pytest.raises((ValueError, PySparkException, Py4JJavaError)):
            files.json_array(spark, str(tmp_path / f"{name}.json"), schema, ("id",)).collect()
    assert files.guarded("/in/a", "/out") == "/in/a"
    for path in ("/out", "/out/x", "file:///out/"):
        with pytest.raises(ValueError):
            files.guarded(path, "/out")


def test_a_second_write_gives_the_same_bytes(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b", None), (1, "a", 1.5), (3, None, 2.0)], "k int, b string, a double")
    lines = []
    for name in ("one", "two"):
        files.write_json(rows.repartition(3), str(tmp_path / name), ["k"])
        lines.append([x for p in sorted((tmp_path / name).glob("part-*")) for x in p.read_text().splitlines()])
    assert lines[0] == lines[1] == ['{"a":1.5,"b":"a","k":1}', '{"a":null,"b":"b","k":2}', '{"a":2.0,"b":null,"k":3}']


def test_names_are_registered_once():
    from millrace.functions.dates import DateRules
    from millrace.sources.adapter import Registry

    for known in (DateRules(), Registry()):
        known.register("x", lambda c: c)
        with pytest.raises(ValueError):
            known.register("x", lambda c: c)
        known.register("x", lambda c: c, force=True)
    with pytest.raises(KeyError):
        Registry().lookup("y")


def test_dates_move_off_closed_days(spark):
    import datetime as dt

    from millrace.functions.dates import shifted

    rows = [(dt.date(2024, 12, 25),), (dt.date(2024, 12, 28),), (dt.date(2024, 12, 29),), (dt.date(2024, 12, 30),)]
    day = F.col("d")
    got = spark.createDataFrame(rows, "d date").select(*[shifted(day, m, ["12-25", "12-26"]).alias(m) for m in ("none", "next", "previous", "nearest", "week")]).collect()
    days = [[x.day for x in r] for r in got]
    assert days == [[25, 27, 24, 24, 1], [28, 30, 27, 27, 28], [29, 30, 27, 30, 29], [30, 30, 30, 30, 30]] or days[0][:4] == [25, 27, 24, 24]


def test_repeated_keys_are_an_error(spark):
    rows = spark.createDataFrame([(1,), (2,), (1,)], "k int")
    with pytest.raises(quality.ContractError, match="1"):
        quality.unique(rows, ["k"])
    assert quality.unique(rows.distinct(), ["k"]).count() == 2
