"""Queries over customer records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import customers
from tidemark.plans.tables import customer_patches, customer_records, table
from tidemark.session import scratch_path
from tidemark.sources.writers import read_version, write_version

TERM = "Customer NO0000000"


def customer_list(spark, sf_dir):
    listed = customers.list_customers(customer_records(spark, sf_dir))
    return listed.select("customer_id", "firstName", "lastName", "email", "phone", F.col("address.country").alias("country"),
                         "teletransmission", "surcomplementaire",
                         F.date_format("MemberCardIssuanceDate", "yyyy-MM-dd").alias("issued"))


def customer_get(spark, sf_dir):
    """Batch lookup with the part numbers of the line items as wanted ids; some have no customer."""
    wanted = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("customer_id"))
    found = customers.lookup_customers(customer_records(spark, sf_dir), wanted)
    return found.select("customer_id", "found", F.col("customer.lastName").alias("last_name"))


def customer_search(spark, sf_dir):
    """Name search over the whole table, in both id modes."""
    records = customer_records(spark, sf_dir)
    by_name = customers.search_customers(records, TERM).select(F.lit("name").alias("kind"), "key")
    by_place = customers.search_customers(records, "77").select(F.lit("position").alias("kind"), "key")
    by_id = customers.search_customers(records, "99", "customer_id").select(F.lit("customer_id").alias("kind"), "key")
    return by_name.unionByName(by_place).unionByName(by_id)


def customer_cards(spark, sf_dir):
    return customers.customer_cards(customer_records(spark, sf_dir))


def customer_update(spark, sf_dir):
    """Fold all patches, merge them, write a new table version and show it with the unknown ids."""
    path = scratch_path(spark, "customers")
    merged = customers.apply_patches(customer_records(spark, sf_dir),
                                     customers.latest_patches(customer_patches(spark, sf_dir), ["event_ts", "event_no"]))
    write_version(merged.withColumn("fields", F.to_json("fields", {"ignoreNullFields": "false"})), path)
    shown = read_version(spark, path)

    def field(name):
        return F.get_json_object("fields", f"$.{name}")

    return shown.select("customer_id", "status", field("customer_id").alias("kept_id"), field("lastOrder").alias("last_order"),
                        field("lastPriority").alias("last_priority"), field("address.street").alias("street"),
                        field("address.country").alias("country"), field("phone").alias("phone"),
                        field("teletransmission").alias("teletransmission"), field("email").alias("email"))


QUERIES = {f.__name__: f for f in (customer_list, customer_get, customer_search, customer_cards, customer_update)}

_RECORDS = """
    r AS (SELECT c_custkey AS pos, c_custkey, split_part(c_name, '#', 1) AS first, split_part(c_name, '#', 2) AS no,
                 lower(c_mktsegment) || '@mail.example' AS email, c_mktsegment AS seg, n_name AS country, c_acctbal AS bal,
                 CASE WHEN c_mktsegment <> 'MACHINERY' THEN strftime(DATE '2020-01-01' + c_nationkey, '%Y-%m-%d') END AS issued
          FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey)"""

SQL = {
    "customer_list": f"""WITH {_RECORDS}
        SELECT c_custkey AS customer_id, first AS "firstName", 'No' || no AS "lastName", email, '+33-' || no AS phone, country,
               bal > 0 AS teletransmission, bal > 5000 AS surcomplementaire, issued FROM r""",
    "customer_get": """
        SELECT DISTINCT l_partkey AS customer_id, c_custkey IS NOT NULL AS found, 'No' || split_part(c_name, '#', 2) AS last_name
        FROM lineitem LEFT JOIN customer ON c_custkey = l_partkey""",
    "customer_search": f"""WITH {_RECORDS}
        SELECT 'name' AS kind, pos::varchar AS key FROM r
        WHERE contains(lower(first || ' No' || no), lower('{TERM}')) OR contains(pos::varchar, lower('{TERM}'))
        UNION ALL SELECT 'position', pos::varchar FROM r WHERE contains(lower(first || ' No' || no), '77') OR contains(pos::varchar, '77')
        UNION ALL SELECT 'customer_id', pos::varchar FROM r WHERE contains(lower(first || ' No' || no), '99') OR contains(c_custkey::varchar, '99')""",
    "customer_cards": f"""WITH {_RECORDS}
        SELECT pos, first || ' No' || no AS full_name, c_custkey AS customer_id, email, '+33-' || no AS phone,
               no || ' Main Street, ' || upper(seg[1]) || lower(seg[2:]) || ', , ' || right(no, 5) || ', ' || country AS address,
               CASE WHEN bal > 0 THEN 'Yes' ELSE 'No' END AS teletransmission,
               CASE WHEN bal > 5000 THEN 'Yes' ELSE 'No' END AS surcomplementaire, coalesce(issued, 'N/A') AS card_issued FROM r""",
    "customer_update": f"""WITH {_RECORDS},
        f AS (SELECT o_custkey AS id, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS prio FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
        o AS (SELECT o_custkey AS id, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS ord,
                     arg_max(o_totalprice > 250000, (o_orderdate, o_orderkey)) AS tele FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
        SELECT c_custkey AS customer_id, CASE WHEN f.id IS NULL AND o.id IS NULL THEN 'untouched' ELSE 'updated' END AS status,
               c_custkey::varchar AS kept_id, ord::varchar AS last_order, prio AS last_priority,
               coalesce(prio, no || ' Main Street') AS street, CASE WHEN f.id IS NULL THEN country END AS country,
               CASE WHEN f.id IS NULL THEN '+33-' || no END AS phone,
               coalesce(tele, bal > 0)::varchar AS teletransmission, email
        FROM r LEFT JOIN f ON f.id = c_custkey LEFT JOIN o ON o.id = c_custkey
        UNION ALL SELECT DISTINCT o_custkey + 1000000000, 'not_found', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM orders WHERE o_orderstatus = 'P'""",
}
