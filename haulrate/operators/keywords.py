"""Keywords found in listing and item titles, and the difficulty they imply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from haulrate.functions import has_text, match_key
from haulrate.operators.lookups import join_side, rank
from haulrate.operators.shipments import SLOTS, slot
from haulrate.sources.cards import Card
from haulrate.sources.shared import staged

PARTS = ["title"] + [f"item{k}" for k in range(1, SLOTS + 1)]
SEPARATOR = " / "
#: Letters of the gram that a keyword is filed under. Few keywords share so many, however many there
#: are; a keyword that is no longer is its own gram, met by nothing but itself.
GRAM = 8
DIGEST = "__texts"

FIELDS = ("keyword", "needle", "difficulty_idx", "fragile_idx")
WORD_FIELDS = "keyword:string,needle:string,difficulty_idx:double,fragile_idx:double"
WORDS = f"array<struct<{WORD_FIELDS}>>"


def keyword_rows(card: Card) -> Card:
    """Keywords with their indexes; a keyword without text matches nothing, and as indexes
    never count below 0, a missing one is 0."""
    rows = card.df.where(F.length("keyword") > 0).select(
        "id",
        "keyword",
        F.lower("keyword").alias("needle"),
        *[F.coalesce(index, F.lit(0.0)).alias(index) for index in FIELDS[2:]],
    )
    return card.derive(rows)


def _texts() -> dict[str, Column]:
    """The searched text of each part; item 2 and up only if the shipment has so many items."""
    texts = {"title": F.lower("title"), "item1": F.lower(slot(1, "title"))}
    for k in range(2, SLOTS + 1):
        texts[f"item{k}"] = F.when(F.col("totalitems") >= k, F.lower(slot(k, "title")))
    return texts


def _literal_words(rows: list[Row]) -> Column:
    """The keywords in load order, as an array that Catalyst folds to one constant.

    Texts are written as bytes, so that nothing in them has a meaning for the parser.
    """

    def literal(value: str | float) -> str:
        if isinstance(value, str):
            return f"cast(X'{value.encode().hex()}' AS string)"
        return f"cast('{value!r}' AS double)"

    ordered = sorted(rows, key=lambda row: [rank(row[f]) for f in ("id", *FIELDS)])
    words = [", ".join(f"'{f}', {literal(row[f])}" for f in FIELDS) for row in ordered]
    return F.expr(f"cast(array({', '.join(f'named_struct({word})' for word in words)}) AS {WORDS})")


def _grams(text: Column, size: int | Column) -> Column:
    """Every run of ``size`` letters with the number of its first letter, as an array."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    of = F.lit(size) if isinstance(size, int) else size
    return F.transform(
        starts, lambda at: F.struct(at.alias("at"), F.substring(text, at, of).alias("gram"))
    )


def anchors(
    parts: DataFrame, words: DataFrame, sizes: list[int], longest: int | None = None
) -> DataFrame:
    """Each keyword under its rarest gram in the texts, with how far into the keyword that is.

    The largest of the sizes is that of a gram; a keyword of fewer letters is its own only gram. Of
    equally rare grams the first one is taken; one that no text has is as good as any, for then the
    keyword is in no text. ``longest``: letters of the longest keyword, if known; if none is longer
    than a gram, nothing is counted.
    """
    size, word = max(sizes), F.struct(*words.columns).alias("word")
    short = words.where(F.length("needle") <= size).select(
        F.col("needle").alias("gram"), F.lit(0).alias("into"), word
    )
    if longest is not None and longest <= size:
        return short
    seen = _text_grams(parts.select("text"), [size]).groupBy("gram").agg(F.count("*").alias("seen"))
    own = _grams(F.col("needle"), size)
    filed = words.where(F.length("needle") > size).select("*", F.explode(own).alias("own"))
    filed = filed.select(*words.columns, "own.gram", (F.col("own.at") - 1).alias("into"))
    counted = filed.join(seen, "gram", "left")
    rarest = F.min(F.struct(F.coalesce("seen", F.lit(0)), "into", "gram")).alias("anchor")
    found = counted.groupBy(*words.columns).agg(rarest)
    return short.unionByName(found.select("anchor.gram", "anchor.into", word))


def _text_grams(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """The rows of ``texts`` with every gram of their text, of each of the sizes."""
    none = F.array().cast("array<struct<at:int,gram:string>>")
    text = F.col("text")
    every = F.concat(
        *[F.when(F.length(text) >= size, _grams(text, size)).otherwise(none) for size in sizes]
    )
    exploded = texts.select("*", F.explode(every).alias("found"))
    return exploded.select(*texts.columns, "found.at", "found.gram")


def _runs(text: Column, words: DataFrame) -> Column:
    """The longest stretches of a text, as an array, of letters that some keyword has: a keyword
    stands within one of them or not at all."""
    letters = words.select(F.explode(F.split("needle", "")).alias("letter")).distinct().collect()
    known = "".join(f"\\x{{{ord(c):x}}}" for c in sorted({c for row in letters for c in row.letter}))
    return F.split(text, f"(?s)[^{known}]+")


def _joined_hits(df: DataFrame, words: Card) -> DataFrame:
    """Add the keywords of every part, as array ``hits`` in the order of PARTS.

    For a keyword list of any size: texts and keywords meet by equality of a gram, the keyword's
    rarest, and are compared at the one place where the keyword would have to stand. A keyword no
    longer than a gram is met whole, so its hits are all that the join gives. Shipments with
    the same texts have the same hits, so what meets the keywords is each different set of texts
    once, written once, and its hits come back to every shipment by the digest of the texts: the
    shipment's own id, which may be missing or repeated, plays no part. Within a part the keywords
    stand in the order of the literal list, as often as the list has them.
    """
    texts = list(_texts().values())
    digest = F.unhex(F.sha2(F.to_json(F.struct(F.array(*texts).alias("texts"))), 256))
    every = F.array(*[F.struct(text.alias("text")) for text in texts])
    parts = df.select(digest.alias(DIGEST), F.posexplode(every).alias("part", "held"))
    runs = F.explode(_runs(F.col("held.text"), words.df)).alias("text")
    parts = parts.select(DIGEST, "part", runs).where(F.length("text") > 0).distinct()
    parts = staged(parts, "texts")

    listed = words.df.groupBy("id", *FIELDS).agg(F.count("*").cast("int").alias("times"))
    lengths = words.df.agg(
        F.collect_set(F.least(F.length("needle"), F.lit(GRAM))), F.max(F.length("needle"))
    )
    sizes, longest = lengths.first()
    sizes = sorted(sizes)
    # A gram carries the letters around it, as many as a longer keyword can reach, not the whole text.
    before = F.least(F.col("at") - 1, F.lit(longest))
    around = F.substring("text", F.col("at") - before, before + longest)
    long = (F.length("gram") == GRAM) if longest > GRAM else F.lit(False)
    probes = _text_grams(parts, sizes).select(
        DIGEST,
        "part",
        "gram",
        F.when(long, before).alias("before"),
        F.when(long, around).alias("around"),
    )
    filed = anchors(parts, listed, sizes, longest)
    met = join_side(probes, filed, {"gram": probes["gram"]}, small=words.small, how="inner")
    start = F.col("before") - F.col("into")
    whole = F.length("word.needle") <= GRAM
    found = F.substring("around", start + 1, F.length("word.needle")) == F.col("word.needle")
    in_order = F.sort_array(F.collect_set(F.struct("part", "word"))).alias("met")
    met = met.where(whole | (start >= 0) & found).groupBy(DIGEST).agg(in_order)
    joined = join_side(df, met, {DIGEST: digest}, small=False)

    def of_part(k: int) -> Column:
        mine = F.transform(F.filter("met", lambda hit: hit["part"] == k), lambda hit: hit["word"])

        def again(word: Column) -> Column:
            return F.array_repeat(F.struct(*[word[f].alias(f) for f in FIELDS]), word["times"])

        return F.coalesce(F.flatten(F.transform(mine, again)), F.array().cast(WORDS))

    hits = F.array(*[of_part(k) for k in range(len(texts))])
    return joined.withColumn("hits", hits).drop("met")


def _joined_keywords(hits: Column, passes: int) -> Column:
    """The matches in load order, joined as repeated passes over the list append them.

    A pass appends a keyword unless the text so far is exactly that keyword. So the first one
    stands once, and with three passes every later one three times.
    """

    def step(text: Column, hit: Column) -> Column:
        word = hit["keyword"]
        append = has_text(text) & (match_key(text) != match_key(word))
        again = F.repeat(F.concat(F.lit(SEPARATOR), word), F.lit(passes))
        return F.when(append, F.concat(text, again)).otherwise(word)

    return F.aggregate(hits, F.lit(None).cast("string"), step)


def _highest(hits: Column, field: str) -> Column:
    return F.greatest(F.lit(0.0), F.array_max(F.transform(hits, lambda hit: hit[field])))


def keyword_indexes(df: DataFrame, card: Card, passes: int = 3) -> DataFrame:
    """Add keyword text, difficulty and fragility of the title and of items 1 to 5."""
    words = keyword_rows(card)
    rows = words.rows_if_at_most(words.limits.keyword_rows)
    if rows is not None:
        array = _literal_words(rows)

        def hits_of(text: Column) -> Column:
            return F.filter(array, lambda word: F.contains(text, word["needle"]))

        # Lambda variables hold each text, and below its matches, so that both are made once.
        hits = F.transform(F.array(*_texts().values()), hits_of)
    else:
        df = _joined_hits(df, words)
        hits = F.col("hits")

    def indexes(found: Column) -> Column:
        return F.struct(
            _joined_keywords(found, passes).alias("keyword"),
            _highest(found, "difficulty_idx").alias("diff"),
            _highest(found, "fragile_idx").alias("frag"),
        )

    df = df.withColumn("hits", F.transform(hits, indexes))
    return df.select(
        *[name for name in df.columns if name != "hits"],
        *[
            F.expr(f"hits[{i}].{kind} AS {part}{kind}")
            for i, part in enumerate(PARTS)
            for kind in ("keyword", "diff", "frag")
        ],
    )


def difficulty_index(df: DataFrame) -> DataFrame:
    """Add difficulty_idx, the whole part of the highest difficulty of any part."""
    highest = F.greatest(*[F.col(f"{part}diff") for part in PARTS])
    return df.withColumn("difficulty_idx", highest.cast("int"))
