"""Names and addresses: the model, what counts as evidence, the grammar, and the gate."""

import re

import pytest
from pyspark.sql import functions as F

from refmill.operators import gates as G
from refmill.operators import personal as P

NAMES = [f"{a} {b}{c}" for a in ("Alice", "Bruno", "Clara") for b in ("Thorn", "Ash", "Whit", "Lang") for c in ("bury", "combe", "ford")]
TEXTS = ["The Market opened in Spring. We saw Blue Rings and a Hot Bolt.", "Der Hund lief zum Haus. Die Katze schlief."] * 60 + ["Alice Springs is in the Northern Territory."]


@pytest.fixture(scope="module")
def model(spark):
    names = spark.createDataFrame([(n,) for n in [*NAMES, None, "", "Single", "lower case"]], "name string")
    return P.fit_names(names, spark.createDataFrame([(t,) for t in [*TEXTS, None, ""]], "text string"))


def hits(spark, detect, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [bool(r.hit) for r in df.select("i", detect(F.col("text")).alias("hit")).orderBy("i").collect()]


def test_trie_matches_exactly_its_words():
    words = ["Ann", "Anna", "Anne", "Ben", "O'Neil", "a.b", "Ångström"]
    pattern = re.compile(P.trie_pattern(words))
    assert all(pattern.fullmatch(w) for w in words)
    assert not any(pattern.fullmatch(w) for w in ["An", "Annaa", "aXb", "", "Be", "O"])
    assert P.trie_pattern(["Ann", "Anna"]).count("Ann") == 1
    assert re.compile(P.trie_pattern([])).search("anything") is None


def test_names_are_found_by_words_and_surroundings(spark, model):
    found = ["met Alice Thornbury today", "Alice J. Whitcombe", "Dear Clara Langford,", "ask Mr Zoltan Harford", "signed by Frau Bruno Pemcombe", "Bruno Woodbury"]
    assert hits(spark, model.detector(), found) == [True] * len(found)
    clean = ["the Blue Ring", "a Hot Bolt and Market Days", "Der Hund", "alice thornbury", "Alice", "ALICE THORNBURY", "Xaver Qqqq", "", None, "Alice, Thornbury", "Winter Games for All"]
    assert not any(hits(spark, model.detector(), clean))


def test_context_alone_or_one_common_word_is_not_enough(spark, model):
    assert not any(hits(spark, model.detector(), ["Mr Zoltan Qqqq", "dear Zoltan Qqqq", "Alice Springs", "from Rome Paris"]))


def test_name_across_line_and_second_of_two_pairs(spark, model):
    assert all(hits(spark, model.detector(), ["yours,\nAlice Thornbury\n", "Blue Ring. Alice Ashford left", "x" * 100_000 + " Alice Ashford"]))


def test_without_names_nothing_is_found(spark):
    empty = spark.createDataFrame([], "name string")
    model = P.fit_names(empty, spark.createDataFrame([("a",)], "text string"))
    assert not any(hits(spark, model.detector(), ["Mr Alice Thornbury"]))


def test_model_is_bounded(spark):
    names = spark.range(4000).select(F.concat(F.lit("Aa"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"), F.lit(" Bbbbb")).alias("name"))
    model = P.fit_names(names.unionAll(names), spark.createDataFrame([("x",)], "text string"), max_nodes=50)
    assert all(len(p) < 2000 for p in model.first)


def test_addresses(spark):
    found = [
        "at 221B Baker Street, London NW1 6XE", "12 North Hill Rd., Leeds LS1 4AB", "Flat 3, 17 Mill Lane", "Unit 4b 9 Kings Parade, Cambridge",
        "PO Box 77", "p.o. box 1234", "Hauptstraße 12, 10115 Berlin", "Am Markt: Lindenweg 4, Ulm", "12 rue de la Paix, 75002 Paris",
        "350 5th Avenue\nNew York, NY 10118", "1600 Amphitheatre Way, Springfield, IL 62704-1234",
    ]
    assert hits(spark, P.address, found) == [True] * len(found)
    clean = ["12 Blue Rings", "Street", "section 4 Main points", "in 2024 Street art", "the Place", "via 3", "100 places", "", None, "box 12", "PO Boxes", "No. 5 way"]
    assert not any(hits(spark, P.address, clean)) and not any(hits(spark, P.street_line, clean))
    assert hits(spark, P.street_line, ["near 14 Mill Lane yesterday"]) == [True] and hits(spark, P.address, ["near 14 Mill Lane yesterday"]) == [False]


def test_scan_scores_and_threshold(spark, model):
    df = spark.createDataFrame([("Alice Thornbury", "14 Mill Lane"), ("none", "14 Mill Lane, Leeds LS1 4AB")], "a string, b string")
    got = {(r.column_name, r.entity): (r.score, r.hits) for r in G.pii_scan(df, extra=P.person_detector(model)).collect()}
    assert got[("a", "PERSON")] == (0.85, 1) and got[("b", "ADDRESS")] == (0.85, 1) and got[("b", "STREET_LINE")] == (0.5, 2)
    assert {r.entity for r in G.blocking(G.pii_scan(df, extra=P.person_detector(model))).collect()} == {"PERSON", "ADDRESS"}


def test_scan_is_one_pass_without_python(spark, model):
    df = spark.createDataFrame([("x",)], "t string")
    plan = G.pii_scan(df, extra=P.person_detector(model))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan
