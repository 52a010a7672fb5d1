"""Commit logs and bucketed tables under two writers."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.sources.bucketed import BucketedTable
from tidemark.operators import customers
from tidemark.sources.commits import CommitLog, Conflict
from tidemark.sources.readers import read_keyed_customers
from tidemark.sources.writers import append_valid, read_version, remove_versions, write_version
from tidemark.streaming.updates import CustomerTable, start_customer_merges

ADDRESS = {"street": "1 Road", "city": "Nice", "state": "S", "postalCode": "06000", "country": "France"}
PATCH = "customer_id bigint, patch string, at int"


def records(spark, tmp_path, n=200):
    people = {str(i): {"customer_id": i, "firstName": f"F{i}", "lastName": "L", "email": "e", "phone": "0", "address": ADDRESS, "teletransmission": True,
                       "surcomplementaire": False, "MemberCardIssuanceDate": None} for i in range(n)}
    file = tmp_path / "people.json"
    file.write_text(json.dumps(people), encoding="utf-8")
    return read_keyed_customers(spark, str(file)).withColumn("fields", F.to_json("fields", {"ignoreNullFields": "false"}))


@pytest.fixture
def table(spark, tmp_path):
    made = CustomerTable(scratch_path(spark, "customers"))
    made.create(records(spark, tmp_path), [("at", "int")], 16)
    return made


def phones(spark, table):
    return {r.customer.customer_id: r.customer.phone for r in table.records.read(spark).collect()}


def test_a_number_is_committed_once(spark):
    log = CommitLog(spark, scratch_path(spark, "log"))
    assert log.latest() == (0, None)
    assert log.put(1, {"a": 1}) and not log.put(1, {"a": 2}) and log.read(1) == {"a": 1}
    won = []
    threads = [threading.Thread(target=lambda k=k: won.append(log.put(2, {"writer": k}))) for k in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 5 + [True] and log.numbers() == [1, 2]
    threads = [threading.Thread(target=lambda: log.update(lambda s: {"n": s.get("n", 0) + 1})) for _ in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert log.latest()[1] == {"n": 6}
    assert log.expire(1) == list(range(1, 8)) and log.numbers() == [8]


def test_a_patch_rewrites_one_bucket(spark, table, fixed):
    before = table.records._state(spark, None)[1]["folders"]
    table.merge(fixed(PATCH, (7, '{"phone": "1", "vip": true}', 1)), ["at"])
    after = table.records._state(spark, None)[1]["folders"]
    assert set(before) == set(after) and sum(before[b] != after[b] for b in before) == 1
    got = phones(spark, table)
    assert got[7] == "1" and len(got) == 200 and {p for i, p in got.items() if i != 7} == {"0"}
    assert json.loads(table.records.read(spark).filter("customer.customer_id = 7").first().fields)["vip"] is True
    assert phones_of(spark, table, 1)[7] == "0"  # the first version is still there
    assert table.records.remove_old(spark) and phones(spark, table) == got


def phones_of(spark, table, version):
    return {r.customer.customer_id: r.customer.phone for r in table.records.read(spark, version).collect()}


def test_two_writers_keep_both_patches(spark, table, fixed):
    """The second writer commits between the first one's read and its commit, in the same buckets."""
    inner, done = table.records.change, []

    class Overtaken(BucketedTable):
        def change(self, spark, buckets, make, tries=30):
            def overtaken(old):
                made = make(old)
                if not done:
                    done.append(1)
                    table.merge(fixed(PATCH, (7, '{"email": "second"}', 5), (8, '{"phone": "8"}', 5)), ["at"])
                return made
            return super().change(spark, buckets, overtaken, tries)

    class First(CustomerTable):
        @property
        def records(self):
            return Overtaken(f"{self.path}/records", "customer.customer_id")

    assert inner
    First(table.path).merge(fixed(PATCH, (7, '{"phone": "first"}', 4), (9, '{"phone": "9"}', 4)), ["at"])
    rows = {r.customer.customer_id: r.customer for r in table.records.read(spark).collect()}
    assert (rows[7].phone, rows[7].email, rows[8].phone, rows[9].phone) == ("first", "second", "8", "9") and len(rows) == 200


def test_writers_in_threads_keep_all_patches(spark, table, fixed):
    errors = []

    def write(k):
        try:
            for i in range(2):
                table.merge(fixed(PATCH, *[(c, json.dumps({f"w{k}{i}": c}), 1) for c in range(0, 40, 3)]), ["at"])
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    for row in table.records.read(spark).collect():
        own = json.loads(row.fields)
        assert all((own.get(f"w{k}{i}") == row.customer.customer_id) == (row.customer.customer_id in range(0, 40, 3)) for k in range(2) for i in range(2))


def test_late_repeated_and_broken_patches(spark, table, fixed):
    landing, offsets = scratch_path(spark, "feed"), scratch_path(spark, "offsets")
    batches = [[(1, '{"phone": "new"}', 9), (2, "no JSON", 1), (999, '{"phone": "x"}', 1)], [(1, '{"phone": "late", "email": "kept"}', 3), (3, "[1]", 2)]]
    for rows in batches:
        fixed(PATCH, *rows).coalesce(1).write.mode("append").parquet(landing)
        feed = spark.readStream.schema(PATCH).parquet(landing)
        start_customer_merges(feed, table, offsets, ["at"]).awaitTermination()
    row = table.records.read(spark).filter("customer.customer_id = 1").first().customer
    assert (row.phone, row.email) == ("new", "kept") and table.records.read(spark).count() == 200
    told = spark.read.parquet(f"{table.path}/rejected").collect()
    assert sorted((r.customer_id, r.patch, r.batch_id) for r in told) == [(2, "no JSON", 0), (3, "[1]", 1)]
    before = table.records.log(spark).latest()[0]
    table.merge(fixed(PATCH, *batches[1]), ["at"])  # merged again
    assert phones(spark, table)[1] == "new" and table.records.log(spark).latest()[0] >= before


def test_bucketed_tables_refuse_misuse(spark, fixed):
    made = BucketedTable(scratch_path(spark, "table"), "id")
    rows = fixed("id int, v string", *[(i, "a") for i in range(20)])
    with pytest.raises(ValueError):
        made.read(spark)
    assert made.create(rows, 4) == 1 and made.exists(spark)
    with pytest.raises(Conflict):
        made.create(rows, 4)
    with pytest.raises(ValueError):
        made.change(spark, [0], lambda old: rows)
    assert made.change(spark, [], lambda old: old) == 1
    everything = list(range(4))
    made.change(spark, everything, lambda old: old.filter("id < 0"))
    assert made.read(spark).count() == 0 and made.read(spark, 1).count() == 20
    made.change(spark, everything, lambda old: rows.limit(3))
    assert made.read(spark).count() == 3 and len(made.read(spark, buckets=made.touched(rows.filter("id = 1"), "id")).collect()) >= 0


def test_two_versions_never_share_a_number(spark):
    path = scratch_path(spark, "versions")
    numbers = []
    threads = [threading.Thread(target=lambda k=k: numbers.append(write_version(spark.range(k), path))) for k in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(numbers) == [1, 2, 3] and sorted(read_version(spark, path, v).count() for v in numbers) == [1, 2, 3]
    last = read_version(spark, path).count()
    assert remove_versions(spark, path) == [1, 2] and read_version(spark, path).count() == last


def test_valid_rows_of_a_repeated_batch_are_there_once(spark):
    out = scratch_path(spark, "valid")
    for batch, top in ((0, 10), (0, 10), (1, 4)):
        append_valid(spark.range(top), F.col("id") % 2 == 0, f"{out}/good", f"{out}/bad", batch)
    assert spark.read.parquet(f"{out}/good").count() == 7 and spark.read.parquet(f"{out}/bad").count() == 7


def test_a_merge_folds_patches_once(spark, table, fixed, monkeypatch):
    folds, fold = [], customers._latest
    monkeypatch.setattr(customers, "_latest", lambda patches, order: folds.append(order) or fold(patches, order))
    rows = [(5, '{"phone": "old", "email": null, "customer_id": 9}', 1), (5, '{"phone": "new", "extra": {"a": [1, null]}}', 2), (6, "no JSON", 3),
            (7, "{}", 3), (None, '{"phone": "nobody"}', 3), (900, '{"phone": "unknown"}', 3)]
    table.merge(fixed(PATCH, *rows), ["at"])
    assert len(folds) == 1
    table.merge(fixed(PATCH, (5, '{"phone": "late", "email": "first"}', 0)), ["at"])
    assert len(folds) == 2
    own = {r.customer.customer_id: json.loads(r.fields) for r in table.records.read(spark).collect()}
    assert (own[5]["phone"], own[5]["email"], own[5]["extra"], own[5]["customer_id"]) == ("new", None, {"a": [1, None]}, 5)
    assert (own[6]["phone"], own[7]["phone"]) == ("0", "0") and set(own) == set(range(200))
