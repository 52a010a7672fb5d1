import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import customers
from tidemark.session import scratch_path
from tidemark.sources.readers import CUSTOMER_TYPE, read_keyed_customers
from tidemark.sources.writers import read_version, write_version
from tidemark.streaming.updates import start_customer_updates

ADDRESS = {"street": "1 Road", "city": "Nice", "state": "S", "postalCode": "06000", "country": "France"}


def person(number, first, last, **over):
    return {"customer_id": number, "firstName": first, "lastName": last, "email": f"{first}@x.fr", "phone": "1", "address": ADDRESS,
            "teletransmission": True, "surcomplementaire": False, "MemberCardIssuanceDate": "2023-12-25T00:00:00Z"} | over


@pytest.fixture
def records(spark, tmp_path):
    file = tmp_path / "customers.json"
    people = {"1": person(1234, "Amélie", "Durand"), "2": person(2345, "Pierre", "Martin", MemberCardIssuanceDate=None, surcomplementaire=None),
              "3": person(2345, "Second", "Martin"), "4": person(9, "Jean", "Bon", nickname="JB")}
    file.write_text(json.dumps(people, indent=4, ensure_ascii=False), encoding="utf-8")
    return read_keyed_customers(spark, str(file))


def test_list_and_lookup(spark, records, fixed):
    assert [r.firstName for r in customers.list_customers(records).collect()] == ["Amélie", "Pierre", "Second", "Jean"]
    assert customers.get_customer(records, 2345).first().firstName == "Pierre"
    assert customers.get_customer(records, 1).count() == 0
    got = customers.lookup_customers(records, fixed("customer_id bigint", (2345,), (2345,), (1,))).collect()
    assert {(r.customer_id, r.found, r.customer and r.customer.firstName) for r in got} == {(2345, True, "Pierre"), (1, False, None)}


def test_missing_file_is_an_empty_table(spark, tmp_path, records):
    empty = read_keyed_customers(spark, str(tmp_path / "none.json"))
    assert empty.count() == 0 and empty.schema["customer"].dataType == records.schema["customer"].dataType


@pytest.mark.parametrize("term,mode,keys", [
    ("AMÉLIE d", "position", {"1"}), ("", "position", {"1", "2", "3", "4"}), ("2", "position", {"3"}), ("2345", "position", set()),
    ("2345", "customer_id", {"2", "3"}), ("mar", "customer_id", {"2", "3"}), ("zz", "position", set())])
def test_search(records, term, mode, keys):
    assert {r.key for r in customers.search_customers(records, term, mode).collect()} == keys


def test_search_rejects_other_modes(records):
    with pytest.raises(ValueError):
        customers.search_customers(records, "a", "email")


def test_cards(records):
    first, second = customers.customer_cards(records).orderBy("pos").collect()[:2]
    assert (first.full_name, first.address, first.card_issued) == ("Amélie Durand", "1 Road, Nice, S, 06000, France", "2023-12-25")
    assert (first.teletransmission, second.surcomplementaire, second.card_issued) == ("Yes", "No", "N/A")


PATCHES = [(1234, '{"phone": "2", "address": {"city": "Lyon"}}', 1), (1234, '{"phone": "3", "customer_id": 7}', 3), (1234, '{"phone": "9"}', 2),
           (2345, '{"email": null, "vip": true}', 1), (5, '{"phone": "x"}', 1)]


def merged_fields(records, patches):
    merged = customers.apply_patches(records, customers.latest_patches(patches, ["event_ts"]))
    rows = merged.select("customer_id", "pos", "status", F.to_json("fields", {"ignoreNullFields": "false"}).alias("f")).collect()
    return merged, {(r.customer_id, r.pos): (r.status, r.f and json.loads(r.f)) for r in rows}


def test_merge_update(records, fixed):
    merged, got = merged_fields(records, fixed("customer_id bigint, patch string, event_ts int", *PATCHES))
    assert {k: v[0] for k, v in got.items()} == {(1234, 0): "updated", (2345, 1): "updated", (2345, 2): "untouched", (9, 3): "untouched", (5, None): "not_found"}
    amelie, pierre = got[1234, 0][1], got[2345, 1][1]
    assert amelie["phone"] == "3" and amelie["address"] == {"city": "Lyon"} and amelie["customer_id"] == 1234
    assert pierre["email"] is None and "email" in pierre and pierre["vip"] is True and pierre["lastName"] == "Martin"
    assert got[9, 3][1]["nickname"] == "JB"
    again = customers.as_records(merged, CUSTOMER_TYPE)
    assert merged_fields(again, fixed("customer_id bigint, patch string, event_ts int", *PATCHES))[1] == got


def test_versions_switch_when_complete(spark, records):
    path = scratch_path(spark, "table")
    assert write_version(spark.range(2), path) == 1
    assert write_version(read_version(spark, path).union(spark.range(1)), path) == 2
    assert (read_version(spark, path).count(), read_version(spark, path, 1).count()) == (3, 2)


def test_change_feed(spark, records, fixed):
    path, landing = scratch_path(spark, "table"), scratch_path(spark, "feed")
    write_version(records.withColumn("fields", F.to_json("fields")), path)
    schema = "customer_id bigint, patch string, event_ts int"
    for patch in PATCHES[:2]:
        fixed(schema, patch).coalesce(1).write.mode("append").parquet(landing)
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    start_customer_updates(feed, path, scratch_path(spark, "offsets"), ["event_ts"]).awaitTermination()
    row = read_version(spark, path).filter("key = '1'").first()
    assert row.customer.phone == "3" and row.customer.address.city == "Lyon" and row.customer.customer_id == 1234
