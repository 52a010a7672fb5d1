"""Customer records: list, lookup, search, cards and merge updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_FIELD = "customer_id"


def list_customers(records: DataFrame) -> DataFrame:
    """All customers in file order."""
    return records.orderBy("pos").select("customer.*")


def get_customer(records: DataFrame, customer_id: int) -> DataFrame:
    """The first record with this id in file order; empty when there is none."""
    return (records.filter(F.col("customer.customer_id") == customer_id)
            .orderBy("pos").limit(1).select("customer.*"))


def lookup_customers(records: DataFrame, ids: DataFrame) -> DataFrame:
    """Batch lookup of distinct ids: every id comes back, with a ``found`` flag and the first record in file order.

    The first record per id is chosen with an aggregate before the join, so
    repeated ids do not multiply.
    """
    first = records.groupBy(F.col("customer.customer_id").alias(ID_FIELD)).agg(
        F.min_by("customer", "pos").alias("customer"))
    wanted = ids.select(ID_FIELD).distinct()
    return wanted.join(first, ID_FIELD, "left").withColumn("found", F.col("customer").isNotNull())


def full_name(customer: Column) -> Column:
    return F.concat_ws(" ", customer["firstName"], customer["lastName"])


def search_customers(records: DataFrame, term: str, id_mode: str = "position") -> DataFrame:
    """Case-insensitive search in the name, or in the id text. An empty term keeps all.

    ``position`` compares the term with the place in the list, which is what the
    list interface does; ``customer_id`` compares it with the id.
    """
    if id_mode not in ("position", "customer_id"):
        raise ValueError("id_mode must be position or customer_id")
    wanted = term.lower()
    key = F.col("pos") if id_mode == "position" else F.col("customer.customer_id")
    hit = (F.contains(F.lower(full_name(F.col("customer"))), F.lit(wanted))
           | F.contains(key.cast("string"), F.lit(wanted)))
    return records.filter(F.coalesce(hit, F.lit(False)))


def customer_cards(records: DataFrame) -> DataFrame:
    """Display form: name, one-line address, Yes/No flags and the issue date or N/A."""
    c = F.col("customer")
    address = [F.coalesce(c["address"][part], F.lit("")) for part in ("street", "city", "state", "postalCode", "country")]

    def yes_no(flag: Column) -> Column:
        return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))

    return records.select(
        "pos", full_name(c).alias("full_name"), c[ID_FIELD].alias(ID_FIELD), c["email"].alias("email"),
        c["phone"].alias("phone"), F.concat_ws(", ", *address).alias("address"),
        yes_no(c["teletransmission"]).alias("teletransmission"),
        yes_no(c["surcomplementaire"]).alias("surcomplementaire"),
        F.coalesce(F.date_format(c["MemberCardIssuanceDate"], "yyyy-MM-dd"), F.lit("N/A")).alias("card_issued"))


def merge_fields(old: Column, patch: Column) -> Column:
    """Shallow update of a field map: nested values are replaced whole, explicit nulls
    are kept, unknown fields are added and the id never changes."""
    new = F.map_filter(patch, lambda k, _: k != ID_FIELD)
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(kept, new)


def rejected_patches(patches: DataFrame) -> DataFrame:
    """Patches that are not a JSON object, which the updates leave out."""
    return patches.filter(F.from_json("patch", "map<string,variant>").isNull())


def patches_with_fields(patches: DataFrame) -> DataFrame:
    """Patches that are a JSON object with at least one field."""
    return patches.filter(F.size(F.from_json("patch", "map<string,variant>")) > 0)


def _latest(patches: DataFrame, order: list[str]) -> DataFrame:
    """(customer_id, field, last): per field the value and order that come last."""
    fields = patches.select(ID_FIELD, *order, F.explode(F.from_json("patch", "map<string,variant>")).alias("field", "value"))
    return fields.groupBy(ID_FIELD, "field").agg(
        F.max_by(F.struct("value", *order), F.struct(*order)).alias("last"))


def latest_fields(patches: DataFrame, order: list[str]) -> DataFrame:
    """Patches of one field each, the latest of each customer and field, with their order."""
    whole = F.to_json(F.map_from_arrays(F.array("field"), F.array("last.value")), {"ignoreNullFields": "false"})
    return _latest(patches, order).select(ID_FIELD, whole.alias("patch"), *(f"last.{c}" for c in order))


def latest_patches(patches: DataFrame, order: list[str]) -> DataFrame:
    """One patch map per customer from many: per field the value that comes last in the given order.

    ``patches`` has (customer_id, patch as JSON text, <order columns>). Values are
    folded per (customer, field) before the shuffle, so a customer with very many
    patches sends one value per field and task.
    """
    last = _latest(patches, order)
    return last.groupBy(ID_FIELD).agg(
        F.map_from_entries(F.collect_list(F.struct("field", "last.value"))).alias("patch"))


def joined_fields(latest: DataFrame) -> DataFrame:
    """One patch map per customer from patches that ``latest_fields`` has made: they are folded already, so no field comes twice."""
    entries = F.map_entries(F.from_json("patch", "map<string,variant>"))
    return latest.groupBy(ID_FIELD).agg(F.map_from_entries(F.flatten(F.collect_list(entries))).alias("patch"))


def apply_patches(records: DataFrame, patches: DataFrame) -> DataFrame:
    """Merge one patch map per customer into the records: (customer_id, pos, key, fields, status).

    Only the first record of an id is updated. ``status`` is updated, untouched,
    or not_found for a patch without a record.
    """
    known = records.select(F.col("customer.customer_id").alias(ID_FIELD), "pos", "key", "fields")
    first = known.groupBy(ID_FIELD).agg(F.min("pos").alias("pos"))
    aimed = patches.join(first, ID_FIELD, "left")
    joined = known.join(aimed, [ID_FIELD, "pos"], "full")
    status = (F.when(F.col("fields").isNull(), F.lit("not_found"))
              .when(F.col("patch").isNull(), F.lit("untouched"))
              .otherwise(F.lit("updated")))
    merged = (F.when(F.col("fields").isNotNull() & F.col("patch").isNotNull(),
                     merge_fields(F.col("fields"), F.col("patch")))
              .otherwise(F.col("fields")))
    return joined.select(ID_FIELD, "pos", "key", merged.alias("fields"), status.alias("status"))


def as_records(merged: DataFrame, customer_type: str) -> DataFrame:
    """Updated rows back in record form (pos, key, customer, fields); unknown ids are left out."""
    found = merged.filter(F.col("status") != "not_found")
    return found.select("pos", "key", F.from_json(F.to_json("fields"), customer_type).alias("customer"), "fields")
