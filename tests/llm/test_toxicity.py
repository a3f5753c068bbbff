import random

import pytest

from haulrate.llm import toxicity
from haulrate.llm.toxicity import Model, clause_matches


def _symbols(words):
    model = toxicity.seeded()
    matcher = toxicity.Matcher(model)
    return [matcher._symbol(word) for word in words.split()]


@pytest.mark.parametrize(
    "words, match",
    [
        ("an idiot spoke", "plain insult"),
        ("you are an idiot", "directed insult"),
        ("idiot that you are", "directed insult"),
        ("he is not an idiot", "negated insult"),
        ("she said that the idiot left", "reported insult"),
        ('the " idiot " left', "reported insult"),
        ("i will kill you", "directed threat"),
        ("never kill anyone", "negated threat"),
    ],
)
def test_grammar(words, match):
    assert match in clause_matches(_symbols(words))


def test_words_far_apart_do_not_meet():
    assert set(clause_matches(_symbols("you saw how the very old idiot left"))) == {"plain insult"}
    assert set(clause_matches(_symbols("not that it much matters that idiot left"))) == {"plain insult"}
    assert clause_matches(_symbols("you and they said no")) == {}


def test_clauses_not_words():
    matcher = toxicity.Matcher(Model({"idiot": ("insult", 4.0)}, {"lowe": ("insult", 4.0)}))
    sums, clauses = matcher.features("You idiot, you idiot! No idiot. Lowerstuff here; fine.")
    assert clauses == 3 and sum(x > 0 for x in sums) == 3
    assert matcher.features("nothing, antiidiot, unlowered") == ([0.0] * len(toxicity.MATCHES), 0)
    assert matcher.features("") == ([0.0] * len(toxicity.MATCHES), 0)


@pytest.fixture(scope="module")
def labelled(spark):
    """Made-up words, of which some families are in toxic texts only."""
    rng = random.Random(1)
    docs, labels = [], []
    for k in range(900):
        words = [f"{rng.choice('bdfgk')}{rng.choice('aeiou')}{rng.randrange(99)}a" for _ in range(60)]
        words = ["".join(c if c.isalpha() else chr(97 + int(c)) for c in word) for word in words]
        toxic = int(k % 5 == 0)
        for _ in range(2 * toxic):
            words[rng.randrange(60)] = "zorkl" + rng.choice(("", "en", "us", "iti", "abo"))
        docs.append((k, " ".join(words) + "."))
        labels.append((k, toxic))
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_learns_word_families_and_holds_out(docs, labelled):
    pairs, labels = labelled
    df = docs(pairs)
    rows = toxicity.score(df, toxicity.fit(df, labels)).collect()
    held = [row for row in rows if row.held_out]
    assert len(rows) == len(pairs) and 100 < len(held) < 300
    assert all(row.predicted == int(row.doc_id % 5 == 0) for row in held)
    assert all(0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5) for row in rows)


def test_held_out_labels_teach_nothing(docs, labelled, spark):
    pairs, labels = labelled
    df = docs(pairs)
    flipped = labels.withColumn(
        "toxic", toxicity.F.when(toxicity.held_out(), 1 - labels["toxic"]).otherwise(labels["toxic"])
    )
    first, second = toxicity.fit(df, labels), toxicity.fit(df, flipped)
    assert first.words == second.words and first.prefixes == second.prefixes
    assert (first.weights == second.weights).all() and first.bias == second.bias


def test_table_held_out(spark):
    """Enough labels for the families of four languages."""
    sf_dir = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(df, toxicity.fit(df, labels))
    rows = scored.join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic = [row.predicted for row in rows if row.toxic]
    clean = [row.predicted for row in rows if not row.toxic]
    assert sum(toxic) / len(toxic) > 0.75 and sum(clean) / len(clean) < 0.01


def test_awkward_rows(awkward, docs, spark):
    labels = spark.createDataFrame(
        [(1, None), (4, 1), (4, 0), (None, 1), (77, 1), (6, 0)], "doc_id bigint, toxic int"
    )
    model = toxicity.fit(awkward, labels)
    assert toxicity.score(awkward, model).count() == awkward.count()
    kept = toxicity.reject_toxic(awkward, labels)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    empty = docs([])
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0


def test_reject(docs, spark):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    df = docs([(1, "you are an idiot and a moron! you scum. you stupid loser."), (2, "fine"), (3, None)])
    assert sorted(row.doc_id for row in toxicity.reject_toxic(df, labels).collect()) == [2, 3]
