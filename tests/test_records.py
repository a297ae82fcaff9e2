import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import dates
from millrace.functions import scalars as S
from millrace.operators import ledger, matching, quality, records, rules
from millrace.sources import files
from millrace.streaming.feed import change_feed


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_raw_events_keep_their_ids_and_count_what_is_unmapped(spark):
    s = spark.createDataFrame([(1, " Lien ", "k1"), (2, "lien", None), (3, "odd", "k1"), (4, None, "k1"), (5, "  ", "k2"), (1, " Lien ", "k1")], "id int, kind string, key string")
    d = spark.createDataFrame([("k1", "Ann"), ("k2", "Bo")], "k string, owner string")
    make = lambda: sorted((r.raw_event_id, r.canonical_type, r.found, r.refs.owner) for r in records.raw_events(s, {"LIEN": "L"}, "kind", d, "key", "k", {"refs": {"owner": F.col("d.owner")}}, [F.col("s.id")]).collect())
    got = make()
    assert got == make() and len(got) == 3 and len({g[0] for g in got}) == 2
    assert {g[1:] for g in got} == {("L", True, "Ann"), ("L", False, None)}
    assert {(r.raw_type, r.n) for r in records.unmapped(s, {"LIEN": "L"}, "kind").collect()} == {("odd", 1), ("", 2)}


def test_notices_share_a_stand_in_place(spark):
    f = spark.createDataFrame([("1 A st", "N1", "tax", "p"), ("1 A st", "N2", "none", "p"), (" ", "N3", "tax", "p"), ("2 B st", None, "tax", "q"), ("0 A st", "N4", None, "p")], "a string, n string, l string, p string")
    found = records.notices(f, "a", "n", "l", {"tax": "T", "mortgage": "M"}, [F.col("p")])
    assert sorted((r.number, r.type) for r in found.collect()) == [("N1", "T"), ("N2", "M"), ("N4", "M")]
    assert [(r.address, r.notices) for r in records.places(found).collect()] == [("0 A st", 3)]


def test_parties_by_class_and_flags(spark):
    got = one(spark, records.tagged_by_class(F.array(F.lit("Estate of Ann"), F.lit(" "), F.lit("Bo"), F.lit(None).cast("string"), F.lit("X LLC")), [("estate", "estate"), (r"\bllc\b", "entity")], {"estate": "owner", "individual": "owner"}, "other"))
    assert [tuple(x) for x in got] == [("Estate of Ann", "estate", "owner"), ("Bo", "individual", "owner"), ("X LLC", "entity", "other")]
    assert one(spark, records.tagged_by_class(F.lit(None).cast("array<string>"), [("a", "b")], {}, "o")) == []
    null = F.lit(None)
    assert [one(spark, records.flag_or_code(f.cast("boolean"), c.cast("string"), "v")) for f, c in ((F.lit(False), F.lit("V")), (null, F.lit("xv")), (null, F.lit("x")), (null, F.lit(" ")))] == [False, True, False, None]


def test_a_ledger_with_a_repeated_id_is_not_written(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", 2)], "id string, v int")
    ledger.write_ledger(df, "id", str(tmp_path / "l"))
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).collect()] == ['{"id":"a","v":2}', '{"id":"b","v":1}']
    with pytest.raises(quality.ContractError):
        ledger.write_ledger(df.union(df.limit(1)), "id", str(tmp_path / "m"))
    assert not (tmp_path / "m").exists()


def test_a_queue_remembers_decisions_over_many_runs(spark):
    queue = spark.createDataFrame([], "id int, reasons array<string>, state string, decision string, since int")
    seen = []
    runs = [{1: ["a"], 2: ["a", "b"]}, {1: ["a"]}, {1: ["a", "c"], 2: ["b"]}, {}, {1: ["c"]}]
    for n, run in enumerate(runs):
        now = spark.createDataFrame(list(run.items()) + [(9, [])], "id int, reasons array<string>")
        queue = spark.createDataFrame(ledger.refreshed_queue(queue, now, "id", F.lit(n)).collect(), queue.schema)
        if n == 0:  # someone decides
            queue = queue.withColumns({"state": F.when(F.col("id") == 1, "decided").otherwise(F.col("state")), "decision": F.when(F.col("id") == 1, "keep")})
        seen.append({r.id: (r.state, r.reasons, r.decision, r.since) for r in queue.collect()})
    assert seen[1] == {1: ("decided", ["a"], "keep", 0), 2: ("cleared", ["a", "b"], None, 1)}
    assert seen[2] == {1: ("open", ["a", "c"], "keep", 2), 2: ("open", ["b"], None, 2)}
    assert seen[3][1] == ("cleared", ["a", "c"], "keep", 3) and seen[4][1] == ("open", ["c"], "keep", 4)


def test_reasons_add_up_at_both_limits(spark):
    rules_of = {"x": (F.lit(True), 70), "y": (F.lit(None).cast("boolean"), 9), "z": (F.lit(True), 45.5)}
    for base, want in ((10, 100.0), (-300, 0.0), (-20, 95.5), (None, 100.0)):
        got = one(spark, ledger.with_reasons(rules_of, F.lit(base)))
        assert got.score == want and abs(sum(r.points for r in got.reasons) - want) < 1e-9
    assert one(spark, ledger.adds_up(F.lit(3.0), F.array(F.struct(F.lit("a").alias("reason"), F.lit(2.0).alias("points"))))) is False


def test_header_mismatch(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    good = spark.createDataFrame([("c", "a", 2), ("c", None, 1)], "column string, value string, n long")
    bad = spark.createDataFrame([("c", "a", 3), ("c", "z", 1)], "column string, value string, n long")
    assert quality.header_mismatch(df, good, ["c"]).count() == 0
    assert {tuple(r) for r in quality.header_mismatch(df, bad, ["c"]).collect()} == {("c", "a", 3, 2), ("c", "z", 1, 0), ("c", None, 0, 1)}


def test_a_stream_of_snapshots_feeds_what_changed(spark, tmp_path):
    snaps = [[(1, "a"), (2, "b")], [(1, "a"), (2, "c"), (3, None)], [(1, "a"), (3, None)]]
    for i, rows in enumerate(snaps):
        spark.createDataFrame(rows, "k int, v string").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        stream = spark.readStream.schema("k int, v string").parquet(str(tmp_path / f"in/[0-{i}]"))
        change_feed(stream, str(tmp_path / "out"), str(tmp_path / "c"), ["k"], ["v"])
    got = {(r.batch, r.k, r.v, r.change_status) for r in spark.read.parquet(str(tmp_path / "out/changes")).collect()}
    assert got == {(0, 1, "a", "NEW"), (0, 2, "b", "NEW"), (1, 2, "c", "UPDATED"), (1, 3, None, "NEW"), (2, 2, "c", "GONE")}


def test_csv_files_of_both_encodings(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_bytes(' Name ,Price, "City"\r\nJosé, 1 ,"New, York"\r\n\r\n  ,x,Köln\r\n'.encode())
    (folder / "b.csv").write_bytes(' Name ,Price, "City"\nJosé,2,"say ""hi"""\nplain,3,\n'.encode("latin-1"))
    schema = StructType().add("City", "string").add("Name", "string").add("Price", "integer").add("Other", "double")
    got = {(r.Name, r.Price, r.City, r.Other) for r in files.csv_of_any_encoding(spark, str(folder), schema).collect()}
    assert got == {("José", 1, "New, York", None), (None, None, "Köln", None), ("José", 2, 'say "hi"', None), ("plain", 3, None, None)}


@pytest.mark.parametrize(("text", "want"), [("123-125B Oak", "123-125B"), ("12a - 14b x", "12A-14B"), ("12345ABC", "12345A"), ("  7", "7"), ("Oak 7", ""), ("12 -x", "12")])
def test_leading_numbers(spark, text, want):
    assert one(spark, S.leading_number(F.lit(text))) == want


@pytest.mark.parametrize(("text", "want", "root"), [("12 N S N OAK ST AVE RD", "OAK", "OAK"), ("N ST", "", "ST"), ("st", "", "ST"), ("12 Oak St Park", "OAK ST PARK", "OAK"), ("", "", ""), (None, "", ""), ("12b", "", ""), ("NO STREET", "NO STREET", "NO"), ("N. Oak", "N. OAK", "N.")])
def test_body_words_and_roots(spark, text, want, root):
    c = F.lit(text).cast("string")
    assert " ".join(one(spark, S.body_words(c, ["N", "S"], ["ST", "AVE", "RD"]))) == want and one(spark, S.root_word(c, ["N", "S"])) == root


def test_plans_stay_small(spark):
    df = spark.createDataFrame([("x", dt.date(2024, 1, 1))], "t string, d date")
    known = dates.DateRules()
    wide = df.select(S.body_words(F.col("t"), list("ABCDEFGH"), list("IJKLMNOP")), *[known.by(F.col("t"), F.col("d"), m, ["01-01"]) for m in ("next", "previous", "nearest")])
    assert len(wide._jdf.queryExecution().analyzed().toString()) < 30_000


def test_empty_labels_and_texts_do_not_raise(spark):
    assert one(spark, rules.fuzzy_label(F.lit(""), ["", "A"])) == ""
    assert one(spark, rules.fuzzy_label(F.lit(None).cast("string"), ["", "A"])) is None


def test_group_matches_agree_with_pairs(spark):
    rows = [(i, f"n{i % 7}" if i % 5 else None, i % 3) for i in range(60)]
    p = spark.createDataFrame(rows, "id int, a string, b int")
    q = p.withColumnRenamed("id", "rid")
    tiers = [("both", 9, ["a", "b"]), ("a", 5, ["a"]), ("b", 1, ["b"])]
    fast = sorted(map(tuple, matching.tiered_match(p, q, "id", "rid", tiers, itself=True).collect()))
    slow = sorted(map(tuple, matching.tiered_match(p, q, "id", "rid", tiers, F.lit(True), itself=True).collect()))
    assert fast == slow and {r[1] for r in fast} == {"both", "a", "b"}
    w = spark.createDataFrame([(i, i % 2, [f"t{i % 4}", f"u{i % 3}"]) for i in range(40)] + [(90, 0, []), (91, None, ["t1"])], "id int, g int, words array<string>")
    c = spark.createDataFrame([(i, i % 2, [f"t{i % 4}", f"u{i % 3}"] + [f"x{k}" for k in range(i // 3)]) for i in range(40)], "cid int, g int, words array<string>")
    pairs = w.join(c.withColumnRenamed("words", "offered"), "g").where("size(words) > 0")
    assert sorted(map(tuple, matching.best_cover(w, c, "id", "cid", "words", ["g"]).collect())) == sorted(map(tuple, matching.best_overlap(pairs, "id", "cid", "words", "offered").collect()))


def test_co_owners_are_tried_in_turn(spark):
    left = spark.createDataFrame([(1, 0, "smith"), (1, 1, "unique"), (2, 0, "smith"), (2, 1, "none"), (3, 0, "many"), (3, 1, "smith")], "k int, o int, name string")
    right = spark.createDataFrame([(10, "smith"), (11, "smith"), (12, "unique")] + [(20 + i, "many") for i in range(9)], "t int, name string")
    got = {r.k: (r.status, r.order, r.matches, r.match) for r in matching.resolve_by(left, right, "k", "t", [["name"]], order="o").collect()}
    assert got == {1: ("definitive", 1, 1, 12), 2: ("ambiguous", 0, 2, None), 3: ("ambiguous", 1, 2, None)}


def test_a_partition_is_pulled_alone_and_globs_take_all_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"z{i % 3}") for i in range(30)], "id int, zone string")
    files.write_partitioned(df, str(tmp_path / "p"), ["zone"])
    pulled = spark.read.schema(df.schema).parquet(str(tmp_path / "p")).where("zone = 'z1'")
    assert sorted(r.id for r in pulled.collect()) == list(range(1, 30, 3))
    plan = pulled._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(zone" in plan and "DataFilters: []" in plan
    for n in ("b", "a", "c"):
        (tmp_path / f"{n}.jsonl").write_text('{"v": "%s"}\n' % n)
    (tmp_path / "skip.txt").write_text("no")
    rows = files.strict_jsonl(spark, str(tmp_path / "*.jsonl"), StructType().add("v", "string"))
    assert sorted(r.v for r in rows.collect()) == ["a", "b", "c"]


def test_entity_names(spark):
    forms = {"limited liability company": "LLC", "company": "CO", "incorporated": "INC"}
    got = [one(spark, S.entity_name(F.lit(n).cast("string"), forms, ["the"])) for n in ("Acme, L.L.C.", "THE ACME limited  liability company", "Bolt Company", "Company Bolt", "A.B. Incorporated.", "Company", "", None)]
    assert got == ["ACME LLC", "ACME LLC", "BOLT CO", "COMPANY BOLT", "AB INC", "CO", "", None]
