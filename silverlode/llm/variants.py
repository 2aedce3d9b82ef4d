"""Spelling variants of a corpus's vocabulary, found by PartEnum signatures.

A word is the multiset of its letters, seen as a binary vector with one place for each (letter, how
manieth).  Words one edit apart (a code point inserted, deleted or replaced) have vectors whose
Hamming distance is two at most.  PartEnum: the places are dealt into ``PARTS`` parts by letter; two
vectors at distance two or less differ in two parts at most, so they agree in all others: of the
signatures that leave out two parts each, enumerated over all pairs of parts, they share one.  Signatures are
equi-joined, and the candidates verified by the edit distance itself.

Which parts' hashes a pair differs in tells which of the signatures it shares is the first; the pair is
kept there alone, so it is verified once and needs no distinct.  (Equal letters have equal hashes; letters that
differ and hash alike only make a signature wider.)

Groups of many words with one signature are split exactly: one edit in words of ``MIN_LENGTH`` code points leaves the
first or the last ``ANCHOR`` of them alone, so every signature comes twice, with the word's beginning and with
its end, and a pair whose beginnings agree counts there alone.  What adaptive execution still finds skewed in the join it splits.

No join here is broadcast: Spark sizes a table by its compressed files, and rows made by an explode as if they were not more, so it would
bring far more to the driver than its limit says.

Counts cover every run of letters of every text (``vocabulary``): runs are counted in the task that reads them
before they are shuffled, so a word in a third of all places is one row a task.

Forms: a word's form is its most frequent near word, if that is ``RATIO`` times as frequent. Counts grow along forms, so they
lead to roots without circles; pointers double in each round (a join by word).

Cases: null and empty texts have no words; a null id writes as nothing before the colon that names a run; repeated rows count again;
an empty table has no words; a word without near words has null form and is its own root; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.llm.shared import forget, written

MIN_LENGTH, MIN_COUNT = 6, 5
RATIO = 5
#: Every DAMAGE-th run by its hash loses a letter.
DAMAGE = 199
PARTS, DISTANCE = 5, 2
#: Bits of hash for the letters of a part.
CELL = 12
ANCHOR = (MIN_LENGTH - 1) // 2 + (MIN_LENGTH - 1) % 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, damage: int = DAMAGE, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of all words that are long and frequent enough.

    Only A-Z are lowered. Where ``damage`` divides the crc32 of ``<doc_id>:<run>``, the run loses the code point that the crc names."""
    text = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(text, F.lit(f"[a-zÀ-ÿ]{{{min_length},}}+"), F.lit(0))).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    word = F.when(F.col("h") % damage == 0, F.concat(F.substring("run", F.lit(1), at), F.expr("substring(run, int(pmod(h, length(run))) + 2)"))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


# which parts differ (a set of bits) -> the number of the first pair of parts that covers them; -1 if none does
_PAIRS = list(combinations(range(PARTS), DISTANCE))
_FIRST = [next((i for i, pair in enumerate(_PAIRS) if all(p in pair for p in range(PARTS) if bits >> p & 1)), -1) for bits in range(1 << PARTS)]


def signed(words: DataFrame) -> DataFrame:
    """word, n, cells, sig: all signatures of all words.

    ``cells`` packs ``CELL`` bits of hash for the letters of each part; a signature hashes the cells without those of two
    parts, and the word's beginning or end.  Its lowest bits say which: the number of the pair, and 1 for the end."""
    cell = f"transform(sequence(0, {PARTS - 1}), p -> shiftleft(xxhash64(array_join(filter(l, x -> ascii(x) % {PARTS} = p), '')) & {(1 << CELL) - 1}L, {CELL} * p))"
    df = words.select("word", "n", F.expr("array_sort(split(word, ''))").alias("l")).select(
        "word", "n", F.expr(f"aggregate({cell}, 0L, (a, x) -> a | x)").alias("cells"))
    marks = [(2 * i + end, sum(((1 << CELL) - 1) << CELL * p for p in range(PARTS) if p not in pair)) for i, pair in enumerate(_PAIRS) for end in (0, 1)]
    choices = ", ".join(f"named_struct('m', {m}, 'kept', {kept}L)" for m, kept in marks)
    df = df.select("word", "n", "cells", F.expr(f"explode(array({choices}))").alias("s"))
    end = f"IF(s.m % 2 = 0, left(word, {ANCHOR}), right(word, {ANCHOR}))"
    return df.select("word", "n", "cells", F.expr(f"shiftleft(xxhash64(cells & s.kept, s.m, {end}), 6) | s.m").alias("sig"))


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: both directions of every pair of words one edit apart."""
    a = signed(words)
    b = a.select("sig", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("cells").alias("other_cells"))
    bits = " + ".join(f"IF(cells & {((1 << CELL) - 1) << CELL * p}L = other_cells & {((1 << CELL) - 1) << CELL * p}L, 0, {1 << p})" for p in range(PARTS))
    first = f"get(array({', '.join(map(str, _FIRST))}), {bits})"
    found = a.join(b.hint("merge"), "sig").filter(
        f"word < other AND abs(length(word) - length(other)) <= 1 AND sig & 63 = 2 * {first} + IF(left(word, {ANCHOR}) = left(other, {ANCHOR}), 0, 1) "
        "AND levenshtein(word, other, 1) = 1")
    both = ("array(named_struct('word', word, 'n', n, 'other', other, 'other_n', other_n), "
            "named_struct('word', other, 'n', other_n, 'other', word, 'other_n', n))")
    return found.select(F.explode(F.expr(both)).alias("p")).select("p.*")


def roots(forms: DataFrame) -> tuple[DataFrame, list[str]]:
    """word, root for every row of ``forms`` (word, form); every step doubles the pointers."""
    now, path = written(forms.select("word", F.col("form").alias("root")), "variant-roots")
    paths = [path]
    while True:
        up = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        nxt = now.join(up.hint("merge"), F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved"))
        nxt, path = written(nxt, "variant-roots")
        paths.append(path)
        now = nxt.select("word", "root")
        if nxt.filter("moved").isEmpty():
            return now, paths


def variants(docs: DataFrame, ratio: int = RATIO, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the vocabulary."""
    words, path = written(vocabulary(docs, **options), "variant-words")
    paths = [path]
    # the most frequent near word; of equal ones the first
    best = near_pairs(words).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("b"))
    best = best.withColumn("ok", F.expr(f"-b.less >= {ratio} * n")).select(
        "word", "n_near", F.when(F.col("ok"), F.col("b.form")).alias("form"), F.when(F.col("ok"), -F.col("b.less")).alias("form_n"))
    best, path = written(best, "variant-forms")
    paths.append(path)
    ends, more = roots(best.filter("form IS NOT NULL").select("word", "form"))
    out = words.join(best.hint("merge"), "word", "left").join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    out, _ = written(out, "variants")
    forget(docs.sparkSession, *paths, *more)
    return out
