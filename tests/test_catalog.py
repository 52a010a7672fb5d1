import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import catalog as rules
from tidemark.operators.catalog import as_json_documents, clean_catalog, number_batches, unusable_specifications
from tidemark.session import scratch_path
from tidemark.sources.readers import CATALOG_COLUMNS, read_catalog
from tidemark.sources.writers import write_jsonl, write_numbered_batches

SPECS = [
    ('{"product_specification"=>[{"key"=>"Type", "value"=>"Shorts"}, {"value"=>"x"}]}', "Type: Shorts, x"),
    ('{"product_specification"=>{"key"=>"Type", "value"=>"Shorts"}}', ""),
    ('[{"key"=>"a", "value"=>"b"}]', "a: b"),
    ("{'product_specification'=>[{'key'=>'a', 'value'=>'b'}]}", "a: b"),
    ('{"product_specification"=>[{"key"=>"n", "value"=>5}, {"key"=>"z", "value"=>0}, {"key"=>"t", "value"=>true}]}', "n: 5, t: True"),
    ('{"product_specification"=>[{"key"=>"only"}, "text", {"key"=>"", "value"=>"v"}, {"key"=>"k", "value"=>""}]}', "v"),
    ('{"other"=>1}', ""), ("nil", ""), ("null", ""), ("5", ""), ("", ""), ('{"product_specification"=>[]}', ""),
    ('{"product_specification"=>[{"key"=>"a=>b", "value"=>"c"}]}', "a:b: c"),
    ("{'product_specification'=>({'key'=>'it\\'s', 'value'=>None}, {'key'=>'x', 'value'=>'\\x41'}, {'key'=>'n', 'value'=>(1, 2)})}", "x: A, n: [1,2]"),
    ("[{'key'=>'a', 'value'=>True}, {'value'=>'t' 'wo'}]", "a: True, two"), ("{'product_specification'=>[b'x']}", ""), ("(1, 2", ""),
]
CATEGORIES = [
    ('["A >> B >> C >> D >> E >> F"]', "A, B, C, D, E"), ("plain", "plain"), ('["Home, Garden >> Pots"]', "Home, Garden, Pots"),
    ("[]", "[]"), ("[null]", "[null]"), ("['A >> B']", "A, B"), ("A >>  >> C", "A, , C"), ("\t A >> B\n", "A, B"), ("", ""),
]
IMAGES = [('["u1", "u2"]', ["u1", "u2"]), ('"lone"', ["lone"]), ("http://broken", []), ("", []), ("['x']", ["x"])]
PRICES = [("999", 999), ("007", 7), ("", None), ("12.5", None), (" 12 ", None), ("-3", None), ("9" * 30, None)]


@pytest.mark.parametrize("rule,cases", [(rules.specification_text, SPECS), (rules.category_path, CATEGORIES),
                                        (rules.image_urls, IMAGES), (rules.price_number, PRICES)])
def test_rules(fixed, rule, cases):
    df = fixed("s string", *[(c[0],) for c in cases])
    got = [(r.s, r.out) for r in df.select("s", rule(F.col("s")).alias("out")).collect()]
    assert got == cases


def raw(fixed, **over):
    base = dict.fromkeys(CATALOG_COLUMNS, "")
    base |= {"uniq_id": "1", "product_name": "Shirt", "brand": "Acme", "product_category_tree": '["A >> B"]',
             "retail_price": "100", "discounted_price": "x"} | over
    return fixed(", ".join(f"{c} string" for c in CATALOG_COLUMNS), tuple(base[c] for c in CATALOG_COLUMNS))


@pytest.mark.parametrize("description,specs,tail", [
    ("", "", ""), ("  Nice. ", "", " Nice."), ("", '[{"value"=>"v"}]', " v"), (" Nice. ", '[{"value"=>"v"}]', " Nice. v")])
def test_embedding_text(fixed, description, specs, tail):
    row = clean_catalog(raw(fixed, description=description, product_specifications=specs)).first()
    assert row.text_for_embedding == "Shirt. Brand: Acme. Category: A, B." + tail


def test_blank_brand_keeps_its_place(fixed):
    assert clean_catalog(raw(fixed, brand="")).first().text_for_embedding == "Shirt. Brand: . Category: A, B."


def test_json_document_has_one_price_each(spark, fixed):
    path = scratch_path(spark, "docs")
    write_jsonl(as_json_documents(clean_catalog(raw(fixed, product_name="Chemise é"))), path)
    doc = json.loads(spark.read.text(path).first().value)
    assert doc["metadata"]["retail_price"] == 100 and doc["metadata"]["discounted_price"] == "x"
    assert doc["metadata"]["image_urls"] == [] and doc["metadata"]["product_name"] == "Chemise é"
    assert "é" in spark.read.text(path).first().value
    with pytest.raises(Exception, match="(?i)exist"):
        write_jsonl(fixed("a int", (1,)), path)


def test_unusable_specifications_are_counted(fixed):
    df = fixed("product_specifications string", ("null",), ("5",), ("nil",), ("[]",))
    assert unusable_specifications(df).first().unusable == 2


def test_csv_scan_keeps_blanks_quotes_and_line_breaks(spark, tmp_path):
    file = tmp_path / "input.csv"
    file.write_text(",".join(CATALOG_COLUMNS) + "\n" + '1,"two\nlines","say ""hi""",,"",,5,,,u\n', encoding="utf-8")
    row = read_catalog(spark, str(file)).first()
    assert (row.product_name, row.brand, row.description, row.image, row.product_url) == ("two\nlines", 'say "hi"', "", "", "u")


def test_numbered_batches_have_exact_sizes(spark):
    out = scratch_path(spark, "batches")
    df = spark.range(1200).repartition(7)
    write_numbered_batches(number_batches(df, ["id"], 500), out)
    rows = spark.read.schema("id long, batch long").json(out)
    sizes = {r.batch: (r.n, r.lo, r.hi) for r in rows.groupBy("batch").agg(
        F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
    assert sizes == {1: (500, 0, 499), 2: (500, 500, 999), 3: (200, 1000, 1199)}
    assert len(set(r[0] for r in rows.select(F.input_file_name()).distinct().collect())) == 3


def test_literals_equal_their_values(fixed):
    import ast
    import json
    import random

    from tidemark.functions.literals import json_of_literal, literal_json
    rng = random.Random(3)

    def value(depth):
        kind = rng.randrange(9 if depth else 6)
        if kind < 6:
            return [None, True, rng.randrange(-9, 10**6), rng.uniform(-1, 1), "".join(rng.choices("ab'\"\\\n\t é漢😀\x07", k=rng.randrange(6))), ""][kind]
        inner = [value(depth - 1) for _ in range(rng.randrange(4))]
        return [inner, tuple(inner), {str(i): v for i, v in enumerate(inner)}][kind - 6]

    texts = [repr(value(3)) for _ in range(300)]
    got = [r[0] for r in fixed("no int, t string", *enumerate(texts)).orderBy("no").select(literal_json(F.col("t"))).collect()]
    for text, found in zip(texts, got):
        assert json.loads(found) == json.loads(json.dumps(ast.literal_eval(text)))
    assert [json_of_literal(t) for t in ("f()", "1 +", "{1: {2}}", "1e999", None, "[" * 100_000)] == [None, None, '{"1": [2]}', None, None, None]
