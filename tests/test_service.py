import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources import service

SCHEMA = StructType().add("id", "integer").add("city", "string").add("street", "string").add("price", "double")


def make(folder):
    """A service over 230 records that writes down each request that it gets."""
    records = [(i, f"c{i % 3}", f"{i % 20} {'Oak' if i % 2 else 'Elm'} st", float(i)) for i in range(230)]
    names = ["id", "city", "street", "price"]
    holds = {"=": lambda a, b: a == b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "in": lambda a, b: a in b, "starts": lambda a, b: a.startswith(b), "contains": lambda a, b: b in a, "present": lambda a, b: a is not None}

    def fetch(request):
        with open(f"{folder}/{uuid.uuid4().hex}.request", "w") as f:
            json.dump(request, f)
        if os.path.exists(f"{folder}/refuse"):
            raise service.Refused("no such column")
        if os.path.exists(f"{folder}/fail"):
            os.remove(f"{folder}/fail")
            raise OSError("for once")
        found = [dict(zip(names, r, strict=True)) for r in records]
        for column, operator, value in request["where"]:
            found = [r for r in found if holds[operator](r[column], value)]
        if "keys" in request:
            found = [r for r in found if r["id"] in request["keys"]]
        if "any" in request:
            found = [r for r in found if any(r["street"].startswith(p) and t in r["street"] for p, t in request["any"])]
        if request.get("count"):
            return json.dumps({"count": len(found)})
        at = request.get("offset", 0)
        return json.dumps({"rows": [[r[f] for f in request["fields"]] for r in found[at : at + request.get("limit", 10_000)]]})

    return fetch


def requests(folder):
    out = []
    for n in os.listdir(folder):
        if n.endswith(".request"):
            with open(f"{folder}/{n}") as f:
                out.append(json.load(f))
            os.remove(f"{folder}/{n}")
    return out


def test_only_what_is_asked_for_is_fetched(spark, tmp_path):
    folder = str(tmp_path)
    service.use_pushdown(spark)
    spark.dataSource.register(service.service("records", SCHEMA, make(folder), key="id"))
    read = lambda: spark.read.format("records").option("page", "20")

    assert read().load().count() == 230
    asked = requests(folder)
    assert sum(bool(a.get("count")) for a in asked) >= 1 and sorted(a["offset"] for a in asked if "offset" in a) == list(range(0, 230, 20))

    some = read().option("fields", "id,city").load().where("city = 'c1' and id >= 100 and id < 160")
    assert some.columns == ["id", "city"] and sorted(r.id for r in some.collect()) == [i for i in range(100, 160) if i % 3 == 1]
    asked = [a for a in requests(folder) if "offset" in a]
    assert len(asked) == 1 and asked[0]["fields"] == ["id", "city"], "one page of 20 rows holds them all"
    assert {(c, o) for c, o, _ in asked[0]["where"]} >= {("city", "="), ("id", ">="), ("id", "<")}

    text = read().load().where(F.col("street").startswith("1") & F.col("street").contains("Oak") & (F.length("street") > 8))
    assert sorted(r.id for r in text.collect()) == [i for i in range(230) if i % 2 and str(i % 20)[0] == "1" and len(f"{i % 20} Oak st") > 8]
    assert all({o for _, o, _ in a["where"]} >= {"starts", "contains"} for a in requests(folder)), "what the service cannot do stays with Spark"


def test_keys_are_asked_for_in_batches(spark, tmp_path):
    folder = str(tmp_path)
    service.use_pushdown(spark)
    spark.dataSource.register(service.service("keyed", SCHEMA, make(folder), key="id"))
    read = spark.read.format("keyed").option("batch", "4").load()
    wanted = [1, 3, 5, 200, 210, 220, 500, 7, 9, 11]
    assert sorted(r.id for r in read.where(F.col("id").isin(wanted)).collect()) == sorted(set(wanted) - {500})
    asked = requests(folder)
    assert sorted(len(a["keys"]) for a in asked) == [2, 4, 4] and not any("offset" in a or a.get("count") for a in asked)
    assert read.where("id = 5 and id in (6, 7)").count() == 0 and not [a for a in requests(folder) if a.get("keys")]

    keys = spark.createDataFrame([(i % 40,) for i in range(200)] + [(None,), (999,)], "k int").repartition(3)
    got = service.lookups(keys, "k", make(folder), SCHEMA, batch=7)
    assert sorted(r.id for r in got.collect()) == list(range(40))
    asked = [k for a in requests(folder) for k in a["keys"]]
    assert sorted(asked) == [*range(40), 999], "each key once"


def test_prefixes_are_asked_for_by_area(spark, tmp_path):
    folder = str(tmp_path)
    asked = spark.createDataFrame([(f"c{i % 2}", str(i), "Oak") for i in range(20)] * 3 + [(None, "1", "x"), ("c2", "7", "Elm")], "city string, prefix string, part string")
    got = service.prefix_lookups(asked, "city", "prefix", "part", make(folder), SCHEMA, batch=6)
    want = {i for i in range(230) if i % 3 in (0, 1) and i % 2 and any(str(i % 20).startswith(str(p)) for p in range(i % 3, 20, 2))}
    assert {r.id for r in got.collect()} == want
    sent = requests(folder)
    assert all(len(a["any"]) <= 6 and a["where"][0][0] == "city" for a in sent) and sum(len(a["any"]) for a in sent) == 21


def test_failures(spark, tmp_path):
    folder = str(tmp_path)
    fetch = make(folder)
    spark.dataSource.register(service.service("failing", SCHEMA, fetch))
    open(f"{folder}/fail", "w").close()
    assert spark.read.format("failing").option("page", "500").load().count() == 230
    open(f"{folder}/refuse", "w").close()
    requests(folder)
    with pytest.raises(service.Refused):
        service.answered(fetch, {"where": []}, attempts=5)
    assert len(requests(folder)) == 1, "what was refused is not asked for again"
    with pytest.raises(RuntimeError, match="bad"):
        service.answered(lambda r: '{"error": "bad"}', {})


PAGE = StructType().add("kind", "string").add("number", "integer").add("line", "integer")


def stream_service(folder):
    def fetch(request):
        with open(f"{folder}/{uuid.uuid4().hex}.request", "w") as f:
            json.dump(request, f)
        if "head" in request:
            with open(f"{folder}/head-{request['head']}") as f:
                return json.dumps({"head": int(f.read())})
        k, n = request["kind"], request["page"]
        if os.path.exists(f"{folder}/broken-{k}-{n}"):
            raise OSError("a broken page")
        return json.dumps({"rows": [[k, n, line] for line in range(n % 3 + 1)]})

    return fetch


def test_a_stream_goes_on_where_it_stopped_and_a_broken_page_holds_it_back(spark, tmp_path):
    folder, out, check = str(tmp_path), str(tmp_path / "out"), str(tmp_path / "check")

    def heads(a, b):
        for k, n in (("a", a), ("b", b)):
            (tmp_path / f"head-{k}").write_text(str(n))

    def load():
        p = f"{folder}/cursor"
        if not os.path.exists(p):
            return {}
        with open(p) as f:
            return json.load(f)

    def save(end):
        with open(f"{folder}/cursor", "w") as f:
            json.dump(end, f)

    spark.dataSource.register(service.pages_stream("articles", PAGE, stream_service(folder), ["a", "b"], (load, save)))

    def run(**options):
        stream = spark.readStream.format("articles").options(**options).load()
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(processingTime="0 seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    def pages():
        return sorted((a["kind"], a["page"]) for a in requests(folder) if "page" in a)

    def rows():
        return sorted((r.kind, r.number, r.line) for r in spark.read.schema(PAGE).parquet(out).collect())

    def lines(a, b):
        return sorted((k, n, line) for k, top in (("a", a), ("b", b)) for n in range(top + 1) for line in range(n % 3 + 1))

    heads(4, -1)
    run()
    assert pages() == [("a", n) for n in range(5)] and rows() == lines(4, -1) and load() == {"a": 4, "b": -1}

    heads(6, 2)
    (tmp_path / "broken-a-6").write_text("")
    with pytest.raises(Exception, match="broken page"):
        run()
    assert rows() == lines(4, -1), "nothing of the failed batch is there"
    requests(folder)

    os.remove(f"{folder}/broken-a-6")
    heads(6, 9)
    run(most="3")
    assert rows() == lines(6, 9) and load() == {"a": 6, "b": 9}
    assert pages() == sorted([("a", 5), ("a", 6)] + [("b", n) for n in range(10)]), "each page once since the restart"

    heads(3, 9)
    run()
    assert pages() == [] and rows() == lines(6, 9), "a head that goes back changes nothing"
