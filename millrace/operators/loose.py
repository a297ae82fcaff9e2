"""Loose matches of names and labels: containment either way, token subsets, and likeness within an edit distance, without comparing all pairs.

Candidates come from equi-joins on what a match must share: the rarest token of a set that is to be contained, the rarest n-gram of a text that is to
be contained, a segment of a label that edits cannot all have touched. Equal texts are compared once, however many rows have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import kept, probed

#: Doublings of ``gram`` up to which long texts are looked up by longer n-grams.
DOUBLINGS = 3


def _grams(c: Column, n: int) -> Column:
    last = F.length(c) - (n - 1)
    spots = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(spots, lambda i: F.substring(c, i, F.lit(n))))


def words_over(c: Column, least: int) -> Column:
    """Distinct words between white space and commas with more than ``least`` characters, upper case."""
    return F.array_distinct(F.filter(F.split(F.upper(c), r"[\s,]+"), lambda w: F.length(w) > least))


def contained_sets(small: DataFrame, large: DataFrame, items: str, key: str = "text") -> DataFrame:
    """Pairs (small, large) of keys whose item arrays are one a subset of the other. An empty array is a subset of none.

    Each small set goes to the large ones that hold its rarest item, of which an inverted index of the large sets tells how many there are.
    """
    index = large.select(F.col(key).alias("large"), F.col(items).alias("offered"), F.explode(items).alias("item"))
    often = index.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    wanted = small.select(F.col(key).alias("small"), F.col(items).alias("wanted"), F.explode(items).alias("item"))
    # An item that no large set has is the rarest, and rightly finds nothing.
    rarest = wanted.hint("merge").join(often, "item", "left").groupBy("small").agg(F.min_by(F.struct("item", "wanted"), F.struct(F.coalesce("n", F.lit(0)), "item")).alias("r"))
    return probed(index, rarest.select("small", "r.*"), "item").where(F.size(F.array_except("wanted", "offered")) == 0).select("small", "large")


def contained_texts(small: DataFrame, large: DataFrame, gram: int = 3, key: str = "text") -> DataFrame:
    """Pairs (small, large) of texts of which one is part of the other. An empty text is part of none.

    A text of fewer than ``gram`` characters is its only gram, and every text is indexed by its shorter grams for that. A longer text goes by its rarest gram of
    ``gram`` characters, doubled as often as they fit (DOUBLINGS times at most), since what shares long grams with it is little more than what contains it.
    Grams travel as hashes; the texts themselves decide.
    """
    sizes = [*range(1, gram), *(gram << i for i in range(DOUBLINGS + 1))]

    def hashed(grams: Column) -> Column:
        return F.transform(grams, lambda g: F.xxhash64(g))

    length, own = F.length(key), F.lit(0)
    for n in sizes:
        own = F.when(length >= n, n).otherwise(own)
    wanted = small.select(F.col(key).alias("small"), own.alias("n")).where("n > 0")
    lengths = {r["n"] for r in wanted.select("n").distinct().collect()}  # gram + DOUBLINGS rows at most
    of_size = F.array().cast("array<string>")
    for n in sorted(lengths):
        of_size = F.when(F.col("n") == n, _grams(F.col("small"), n)).otherwise(of_size)
    wanted = wanted.select("small", F.explode(F.array_distinct(hashed(of_size))).alias("item"))
    posted = [_grams(F.col(key), n) for n in sorted(lengths)] or [F.array().cast("array<string>")]
    index = large.select(F.col(key).alias("large"), F.explode(F.array_distinct(hashed(F.flatten(F.array(*posted))))).alias("item"))
    often = index.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    rarest = wanted.hint("merge").join(often, "item", "left").groupBy("small").agg(F.min_by("item", F.struct(F.coalesce("n", F.lit(0)), "item")).alias("item"))
    return probed(index, rarest, "item").where(F.contains("large", F.col("small"))).select("small", "large")


def loose_match(asked: DataFrame, asked_id: str, asked_name: str, names: DataFrame, names_id: str, name: str, least: int = 2) -> DataFrame:
    """One row for each asked id: id, matches (rows of ``names`` that match), match (the id of the only one, else null).

    A name matches if, in upper case, it contains the asked text or is contained in it, or if the asked words of more than ``least`` characters are among
    its own. Blank texts match nothing. Words are compared between distinct sets of words, and of distinct texts only those pairs are made whose words do not
    match; only counts and the smallest id of each text go on.
    """
    def words(c: str) -> Column:
        return F.array_sort(words_over(F.col(c), least))

    def texts(df: DataFrame, c: str, *more: Column) -> DataFrame:
        return df.select(F.upper(F.col(c)).alias("text"), *more).where(F.trim("text") != "")

    a = kept(texts(asked, asked_name).distinct().withColumn("words", words("text")), "asked")
    b = kept(texts(names, name, F.col(names_id).alias("id")).groupBy("text").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).withColumn("words", words("text")), "names")
    totals = [F.sum("n").alias("n"), F.min("id").alias("id")]

    sets = kept(b.groupBy("words").agg(*totals), "sets")
    subsets = contained_sets(a.select("words").distinct(), sets, "words", "words")
    of_set = subsets.join(sets.withColumnRenamed("words", "large"), "large").groupBy("small").agg(*totals)
    by_words = a.join(of_set.withColumnRenamed("small", "words"), "words").select(F.col("text").alias("a"), "n", "id")

    forward = contained_texts(a, b).select(F.col("small").alias("a"), F.col("large").alias("b"))
    backward = contained_texts(b, a).select(F.col("large").alias("a"), F.col("small").alias("b")).where("a <> b")  # equal texts are forward pairs
    other = (F.size(words("a")) == 0) | (F.size(F.array_except(words("a"), words("b"))) > 0)
    pairs = kept(forward.union(backward).where(other), "pairs")
    by_text = pairs.join(b.select(F.col("text").alias("b"), "n", "id"), "b").select("a", "n", "id")

    found = kept(by_words.union(by_text).groupBy("a").agg(F.sum("n").alias("matches"), F.min("id").alias("id")), "found")
    out = asked.select(F.col(asked_id).alias("asked"), F.upper(F.col(asked_name)).alias("a")).join(found, "a", "left")
    return out.select(F.col("asked").alias(asked_id), F.coalesce("matches", F.lit(0)).alias("matches"), F.when(F.col("matches") == 1, F.col("id")).alias("match"))


#: Digits that are read in place of letters.
CONFUSED = {"0": "O", "1": "I", "5": "S", "8": "B"}


def repaired(c: Column) -> Column:
    """struct<text, swaps>: digits between letters (of words without any other digit) as the letters that they look like, and how many there were."""
    word_of = r"[A-Z]+(?:[0158][A-Z]+)+"
    whole = F.array_join(F.transform(F.split(c, " "), lambda w: F.when(w.rlike(rf"^{word_of}$"), F.translate(w, "".join(CONFUSED), "".join(CONFUSED.values()))).otherwise(w)), " ")
    before, after = F.split(c, ""), F.split(whole, "")
    return F.struct(whole.alias("text"), F.size(F.filter(F.zip_with(before, after, lambda x, y: x != y), lambda d: d)).alias("swaps"))


def _edits(length: Column, least: float) -> Column:
    """Edits that two texts may be apart, of which the longer has so many characters."""
    return F.floor((F.lit(1.0) - least) * length + 1e-9).cast("int")


def like_labels(texts: DataFrame, text: str, labels: DataFrame, label: str, least: float = 0.9) -> DataFrame:
    """Pairs (text, label, distance) of distinct texts with 1 - distance / longer length of ``least`` at least.

    A label of n characters may be e edits from a text (n and ``least`` say how many), so it is cut into e + 1 segments, one of which the text has
    untouched, moved by e places at most. Labels are indexed by (n, segment, its characters) and texts look up what stands in those places.
    """
    labels = labels.select(F.col(label).alias("label")).where("label <> ''").distinct().withColumn("n", F.length("label"))
    # The longest text that the label may meet has n / least characters.
    labels = labels.withColumn("e", _edits(F.floor(F.col("n") / least + 1e-9), least))
    cuts = labels.select("label", "n", "e", F.explode(F.sequence(F.lit(0), F.col("e"))).alias("s"))
    start = F.floor(F.col("n") * F.col("s") / (F.col("e") + 1)).cast("int")
    end = F.floor(F.col("n") * (F.col("s") + 1) / (F.col("e") + 1)).cast("int")
    index = cuts.select("label", "n", "s", F.substring("label", start + 1, end - start).alias("piece"))

    texts = texts.select(F.col(text).alias("text")).where("text <> ''").distinct().withColumn("m", F.length("text"))
    # A table of places by the lengths of text and label, whatever the rows.
    spots = labels.select("n", "e").distinct().withColumn("m", F.explode(F.sequence(F.col("n") - F.col("e"), F.col("n") + F.col("e")))).select("m", "n", "e", F.explode(F.sequence(F.lit(0), F.col("e"))).alias("s"))
    spots = spots.withColumns({"start": start, "size": end - start}).select("m", "n", "s", "size", F.explode(F.sequence(F.greatest(F.lit(0), F.col("start") - F.col("e")), F.least(F.col("m") - F.col("size"), F.col("start") + F.col("e")))).alias("at")).where("at >= 0 and at + size <= m")
    probes = texts.join(spots, "m").select("text", "n", "s", F.substring("text", F.col("at") + 1, F.col("size")).alias("piece")).distinct()
    near = probes.join(index, ["n", "s", "piece"]).select("text", "label").distinct()
    near = near.withColumn("distance", F.levenshtein("text", "label"))
    return near.where(F.col("distance") <= _edits(F.greatest(F.length("text"), F.length("label")), least))


def typed(rows: DataFrame, text: str, labels: DataFrame, label: str, negative: str, markers: list[str], least: float = 0.9, doubtful: int = 3) -> DataFrame:
    """``rows`` with label, confidence and reason: what a registry of labels makes of a raw one.

    Texts are compared in upper case with single spaces. In order: an equal label (100); the most alike label of ``least`` or more, equals going to the first in the
    alphabet (70, or 90 * likeness, whichever is more); the same two for the text with its digits repaired, less 5 for each. A text with one of the
    ``markers`` only takes a label whose ``negative`` column holds: otherwise it gets none, and reason ``polarity_conflict``.
    ``doubtful`` repairs or more are a reason as well (``speculative``), and so is no label (``unknown``); null and blank texts are unknown.
    """
    clean = F.trim(F.regexp_replace(F.upper(F.coalesce(F.col(text), F.lit(""))), r"\s+", " "))
    registry = labels.groupBy(F.trim(F.regexp_replace(F.upper(F.col(label)), r"\s+", " ")).alias("known")).agg(F.min(label).alias("label"), F.bool_or(negative).alias("negative"))
    texts = rows.select(clean.alias("text")).distinct()
    tried = texts.select("text", F.explode(F.array(F.struct(F.col("text").alias("try"), F.lit(0).alias("swaps"), F.lit(0).alias("turn")), F.struct(repaired(F.col("text"))["text"].alias("try"), repaired(F.col("text"))["swaps"].alias("swaps"), F.lit(1).alias("turn")))).alias("x")).select("text", "x.*")
    tried = kept(tried.where("text <> '' and (turn = 0 or swaps > 0)"), "tried")
    alike = like_labels(tried, "try", registry, "known", least).withColumnsRenamed({"text": "try", "label": "known"})
    hits = tried.join(alike, "try").join(registry, "known")
    marked = F.lit(False)
    for m in markers:
        marked = marked | F.contains("text", F.lit(m.upper()))
    likeness = 1 - F.col("distance") / F.greatest(F.length("try"), F.length("known"))
    base = F.when(F.col("distance") == 0, F.lit(100.0)).otherwise(F.greatest(F.lit(70.0), F.round(90 * likeness, 6)))
    # What stands there comes before what was repaired, and equal before alike.
    rank = F.struct("turn", F.col("distance") > 0, -likeness, "known")
    best = hits.groupBy("text").agg(F.min_by(F.struct("label", (base - 5 * F.col("swaps")).alias("confidence"), "swaps", (~F.col("negative") & marked).alias("wrong")), rank).alias("b"))
    out = rows.withColumn("__text", clean).join(best.withColumnRenamed("text", "__text"), "__text", "left")
    wrong = F.coalesce("b.wrong", F.lit(False))
    reason = F.when(F.col("b").isNull(), "unknown").when(wrong, "polarity_conflict").when(F.col("b.swaps") >= doubtful, "speculative")
    return out.withColumns({"label": F.when(~wrong, F.col("b.label")), "confidence": F.when(wrong, 0.0).otherwise(F.coalesce("b.confidence", F.lit(0.0))), "reason": reason}).drop("b", "__text")
