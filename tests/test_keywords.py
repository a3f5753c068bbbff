import random

import pytest
from pyspark.sql import functions as F

from haulrate import Limits
from haulrate.operators import keywords
from haulrate.operators.keywords import difficulty_index, keyword_indexes
from haulrate.sources.cards import Card

ITEM = "struct<title:string,unitcount:string,length:string,height:string,width:string,weight:string>"


def shipments(spark, rows):
    """Rows of (id, title, item titles, totalitems)."""
    slots = [
        (i, title, [(t, "1", "1", "1", "1", "1") if t is not None else None for t in items], n)
        for i, title, items, n in rows
    ]
    schema = f"packagematchid bigint, title string, slots array<{ITEM}>, totalitems int"
    return spark.createDataFrame(slots, schema)


def words(spark, limits, *rows):
    schema = "id int, keyword string, difficulty_idx double, fragile_idx double"
    return Card(spark.createDataFrame(list(rows), schema), limits)


def by_hand(text, rows, passes):
    """One text against the list in order, each keyword tried several times in a row."""
    found, diff, frag = None, 0.0, 0.0
    for _, keyword, difficulty, fragile in sorted(rows):
        if not keyword or text is None or keyword.lower() not in text.lower():
            continue
        for _ in range(passes):
            same = found is not None and found.lower().rstrip(" ") == keyword.lower().rstrip(" ")
            if found is not None and found.rstrip(" ") > "" and not same:
                found = f"{found} / {keyword}"
            else:
                found = keyword
            diff, frag = max(diff, difficulty or 0.0), max(frag, fragile or 0.0)
    return found, diff, frag


def test_later_matches_repeat_once_per_pass(spark, limits):
    card = words(spark, limits, (1, "a", 1.0, 0.5), (2, "B", 2.7, None), (3, "c", None, 3.0))
    df = shipments(spark, [(1, "cab", ["A"], 1)])
    row = keyword_indexes(df, card).collect()[0]
    assert row.titlekeyword == "a / B / B / B / c / c / c"
    assert (row.titlediff, row.titlefrag) == (2.7, 3.0)
    assert (row.item1keyword, row.item1diff, row.item1frag) == ("a", 1.0, 0.5)
    assert keyword_indexes(df, card, passes=1).collect()[0].titlekeyword == "a / B / c"


def test_empty_keywords_match_nothing_and_nulls_count_as_zero(spark, limits):
    card = words(spark, limits, (1, "", 9.0, 9.0), (2, None, 9.0, 9.0), (3, "x", None, None))
    row = keyword_indexes(shipments(spark, [(1, "box", [None], 1)]), card).collect()[0]
    assert (row.titlekeyword, row.titlediff, row.titlefrag) == ("x", 0.0, 0.0)
    assert (row.item1keyword, row.item1diff) == (None, 0.0)


def test_items_count_only_up_to_the_number_of_items(spark, limits):
    card = words(spark, limits, (1, "x", 2.0, 2.0))
    rows = [(n, "", ["x", "x", "x", "x", "x"], n) for n in range(0, 6)]
    for row in keyword_indexes(shipments(spark, rows), card).collect():
        found = [row[f"item{k}keyword"] for k in range(1, 6)]
        n = max(row.totalitems, 1)  # item 1 always counts
        assert found == ["x"] * n + [None] * (5 - n)


def test_difficulty_is_the_whole_part_of_the_highest(spark, limits):
    card = words(spark, limits, (1, "low", 1.9, 0.0), (2, "high", 2.7, 0.0))
    rows = [(1, "low", ["high"], 1), (2, "low", [None], 1), (3, "none", ["low", "high"], 1)]
    df = difficulty_index(keyword_indexes(shipments(spark, rows), card))
    found = {row.packagematchid: row.difficulty_idx for row in df.collect()}
    assert found == {1: 2, 2: 1, 3: 1}


@pytest.mark.parametrize("passes", [1, 3])
def test_random_texts_agree_with_the_loop(spark, limits, passes):
    rng = random.Random(7)

    def text(longest):
        return "".join(rng.choice("abAB /") for _ in range(rng.randint(0, longest)))

    rows = [(i, text(4), rng.choice([None, 0.5, 1.5]), rng.choice([None, 2.0])) for i in range(25)]
    rows += [(40, "a", 1.0, 1.0), (41, "A", 3.0, 1.0), (42, "a / b", 1.0, 1.0)]
    given = [(i, rng.choice([None, text(12)]), [text(9)], 1) for i in range(60)]
    df = keyword_indexes(shipments(spark, given), words(spark, limits, *rows), passes)
    found = {row.packagematchid: row for row in df.collect()}
    assert len(found) == len(given)
    for i, title, (item,), _ in given:
        row = found[i]
        assert (row.titlekeyword, row.titlediff, row.titlefrag) == by_hand(title, rows, passes)
        assert (row.item1keyword, row.item1diff, row.item1frag) == by_hand(item, rows, passes)


def test_whole_long_texts_are_searched(spark, limits):
    card = words(spark, limits, (1, "needle", 1.0, 1.0))
    df = shipments(spark, [(1, "x" * 50_000 + " Needle", [None], 1)])
    assert keyword_indexes(df, card).select(F.col("titlekeyword")).collect()[0][0] == "needle"


def test_equal_ids_are_ordered_alike_at_every_size(spark, limits):
    card = words(spark, limits, (1, "ring", 1.0, 1.0), (1, "old", 2.0, 2.0), (1, "gold", 0.0, None))
    df = shipments(spark, [(1, "old gold ring", [None], 1)])
    assert keyword_indexes(df, card, passes=1).collect()[0].titlekeyword == "gold / old / ring"


def test_answers_depend_on_neither_limits_nor_row_ids(spark, limits):
    """Ids that repeat or are missing, keywords without ids, and keywords listed twice."""
    rows = [
        (7, "ring in a box", ["box"], 1), (7, "box", ["ring", None], 2), (None, "ring", [], 0),
        (None, "a box", ["ring ring"], 1), (7, "ring in a box", ["box"], 1), (8, None, [None], 1),
        (8, "", ["bo"], 1), (9, "ünbox 日本 ring", ["x"], 1),
    ]
    listed = [
        (3, "ring", 1.0, 0.5), (None, "box", 2.0, None), (3, "ring", 1.0, 0.5), (1, "in", 0.5, 2.0),
        (None, "x", 0.25, 0.1), (4, "本 r", 3.0, 1.0), (5, "ring in a box", 4.0, 1.0), (6, "ox", 1.0, 9.0),
    ]
    card = words(spark, limits, *listed)
    found = keyword_indexes(shipments(spark, rows), card, passes=1)
    assert found.count() == len(rows)
    titles = sorted((r.title or "", r.titlekeyword or "", r.titlediff, r.titlefrag) for r in found.collect())
    assert titles == sorted([
        ("ring in a box", "box / x / in / ring / ring / ring in a box / ox", 4.0, 9.0),
        ("ring in a box", "box / x / in / ring / ring / ring in a box / ox", 4.0, 9.0),
        ("box", "box / x / ox", 2.0, 9.0),
        ("ring", "in / ring / ring", 1.0, 2.0),
        ("a box", "box / x / ox", 2.0, 9.0),
        ("", "", 0.0, 0.0),
        ("", "", 0.0, 0.0),
        ("ünbox 日本 ring", "box / x / in / ring / ring / 本 r / ox", 3.0, 9.0),
    ])


def test_a_keyword_is_filed_under_its_rarest_gram(spark):
    parts = spark.createDataFrame([("abcabcxyz",), ("abcabd",)], "text string")
    listed = spark.createDataFrame([("abcxyz",), ("ab",), ("zzzz",)], "needle string")
    filed = {r.word.needle: (r.gram, r.into) for r in keywords.anchors(parts, listed, [2, 3]).collect()}
    assert filed == {"abcxyz": ("bcx", 1), "ab": ("ab", 0), "zzzz": ("zzz", 0)}


def test_many_keywords_of_few_letters_meet_only_where_they_stand(spark, monkeypatch):
    """Numbers as keywords share all their short grams; a text meets those that it has, no others."""
    met, join = [], keywords.join_side

    def counted(df, side, on, **how):
        joined = join(df, side, on, **how)
        if "gram" in on:
            met.append(joined.count())
        return joined

    monkeypatch.setattr(keywords, "join_side", counted)
    listed = spark.range(1000, 9000).select(
        "id", F.col("id").cast("string").alias("keyword"),
        F.lit(1.0).alias("difficulty_idx"), F.lit(0.0).alias("fragile_idx"),
    )
    card = Card(listed, Limits(broadcast_rows=0, keyword_rows=0))
    df = shipments(spark, [(k, f"size {k}{k + 1}", [None], 1) for k in range(2000, 2050)])
    found = keyword_indexes(df, card, passes=1).collect()
    for row in found:
        digits = f"{row.packagematchid}{row.packagematchid + 1}"
        numbers = sorted({int(digits[k : k + 4]) for k in range(5)})
        assert row.titlekeyword == " / ".join(str(n) for n in numbers if 1000 <= n < 9000)
    assert met[0] <= 50 * 5


def test_long_keywords_between_letters_that_no_keyword_has(spark):
    listed = [
        (1, "wing chair", 1.0, 0.0), (2, "wing chair with arms", 2.0, 0.0), (3, "armchair", 3.0, 0.0),
        (4, "arm", 4.0, 0.0), (5, "chair w", 5.0, 0.0), (6, "[c]", 6.0, 0.0), (7, "\U0001f6cb", 7.0, 0.0),
    ]
    card = words(spark, Limits(broadcast_rows=0, keyword_rows=0), *listed)
    titles = ["Zwing chair with armsZ", "owing chairs", "armchair\nwing Xchair", "a[c]\U0001f6cb!", "wing", "XYZ"]
    df = shipments(spark, [(k, title, [None], 1) for k, title in enumerate(titles)])
    found = {r.title: r.titlekeyword for r in keyword_indexes(df, card, passes=1).collect()}
    assert [found[title] for title in titles] == [
        "wing chair / wing chair with arms / arm / chair w", "wing chair", "armchair / arm",
        "[c] / \U0001f6cb", None, None,
    ]
