"""Quality rules as a ledger of bits.

Every rule is evaluated once per document.  The ledger keeps the measurements and
one bit for each rule that failed; policies are versioned sets of rules, so a new
policy is a bit mask over an old ledger, and ablations (what would each rule
alone have cost?) come from bitwise aggregates over it without reading a text
again.

All measurements are DataFrame expressions inside the row: nothing is shuffled
and a document's size is the only thing a task's memory follows.  Repeated word
windows are found by the hashes of all windows of a text (64 bits; two different
windows of one text share one with odds of about n^2 / 2^65).

Cases: a null text has no words, lines or symbols and fails the length rule; an
empty or blank text likewise; repeated rows and null ids are rows like any other;
columns of the input never meet the names used here, as they travel in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
BLANK = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PCT = 10, 20
MAX_SYMBOL_PCT, MAX_DUP_LINE_PCT, MAX_UPPER_PCT = 10, 30, 70
MEAN_LENGTH = (2, 15)

# Bit, name, and the failure as an expression over the measurements.
RULES: list[tuple[int, str, str]] = [
    (0, "few_words", f"n_words < {MIN_WORDS}"),
    (1, "repeated_windows", f"100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words"),
    (2, "many_symbols", f"100 * n_symbols > {MAX_SYMBOL_PCT} * n_words"),
    (3, "repeated_lines", f"100 * n_dup_lines > {MAX_DUP_LINE_PCT} * n_lines"),
    (4, "word_length", f"word_chars < {MEAN_LENGTH[0]} * n_words OR word_chars > {MEAN_LENGTH[1]} * n_words"),
    (5, "capitals", f"100 * n_upper > {MAX_UPPER_PCT} * n_letters"),
]
BIT = {name: 1 << bit for bit, name, _ in RULES}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: Policies by version: later ones only add rules, and none leaves out the base.
POLICIES = {1: BASE, 2: BASE | BIT["many_symbols"] | BIT["repeated_lines"],
            3: BASE | BIT["many_symbols"] | BIT["repeated_lines"] | BIT["word_length"] | BIT["capitals"]}
CURRENT = 3
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper"]


def _measured(df: DataFrame, *keep: str) -> DataFrame:
    """``df`` has a text column ``t`` and the columns in ``keep``."""
    trimmed = F.btrim("t", F.lit(BLANK))
    df = df.select(*keep, "t", F.when(trimmed == "", F.array().cast("array<string>"))
                   .otherwise(F.split(trimmed, SPACE + "+")).alias("w"),
                   F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "").alias("l"))
    without = lambda pattern: F.length("t") - F.length(F.regexp_replace("t", pattern, ""))
    df = df.select(
        *keep, F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        without(r"[#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"), F.size("l").cast("long").alias("n_lines"),
        without(r"\p{L}+").cast("long").alias("n_letters"), without(r"\p{Lu}+").cast("long").alias("n_upper"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    rest = [*keep, *(m for m in MEASURES if m != "n_repeat_words")]
    zipped = "arrays_zip(%s)" % ", ".join(f"slice(h, {k}, size(h) - 4)" for k in range(1, 6))
    fields = ", ".join(f"x.`{k}`" for k in range(5))
    df = df.select(*rest, F.expr(f"CASE WHEN size(h) < 6 THEN cast(array() AS array<bigint>) "
                                 f"ELSE transform({zipped}, x -> xxhash64({fields})) END").alias("g"))
    # most texts repeat no window: one hash set tells.  The others sort (hash, place).
    df = df.select(*rest, F.expr("""CASE WHEN size(g) > size(array_distinct(g))
        THEN array_sort(transform(g, (x, i) -> struct(x AS g, i AS i))) END""").alias("s"))
    beside = ("arrays_zip(s, concat(array(cast(NULL AS struct<g:bigint,i:int>)), slice(s, 1, size(s) - 1)), "
              "concat(slice(s, 2, size(s)), array(cast(NULL AS struct<g:bigint,i:int>))))")
    df = df.select(*rest, F.expr(f"""CASE WHEN s IS NOT NULL THEN array_sort(transform(
        filter(cast({beside} AS array<struct<a:struct<g:bigint,i:int>,b:struct<g:bigint,i:int>,c:struct<g:bigint,i:int>>>),
               x -> coalesce(x.a.g = x.b.g, false) OR coalesce(x.a.g = x.c.g, false)), x -> x.a.i)) END""").alias("p"))
    # the union of five words from each place on
    gaps = "zip_with(slice(p, 1, size(p) - 1), slice(p, 2, size(p)), (x, y) -> least(5, y - x))"
    return df.select(*rest, F.expr(f"CASE WHEN p IS NULL THEN 0L ELSE aggregate({gaps}, 5L, (a, x) -> a + x) END")
                     .alias("n_repeat_words"))


def fail_bits() -> Column:
    bits = F.lit(0).cast("long")
    for bit, _, failed in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(failed), F.lit(1 << bit)).otherwise(0).cast("long"))
    return bits


def _ledger(docs: DataFrame, text_col: str) -> DataFrame:
    """row (all columns of the input), the measurements and fail_bits."""
    whole = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"))
    return _measured(whole, "row").withColumn("fail_bits", fail_bits())


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, all measurements, fail_bits."""
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return _ledger(narrow, "text").select("row.doc_id", *MEASURES, "fail_bits")


def passes(policy: int = CURRENT) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy])) == 0


def verdicts(docs: DataFrame, policy: int = CURRENT) -> DataFrame:
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(F.lit(BASE)) != 0).alias("base_failed"), passes(policy).alias("kept"), "fail_bits")


def keep_good(docs: DataFrame, policy: int = CURRENT) -> DataFrame:
    """The documents that pass, with their own columns alone.

    The verdict leans on the row number, which no rule uses: Spark then leaves the filter
    above the measurements, where pushed below it would work them out anew for every rule."""
    kept = passes(policy) & (F.monotonically_increasing_id() >= 0)
    return _ledger(docs, "text").select("row", kept.alias("kept")).filter("kept").select("row.*")


def ablations(ledger_rows: DataFrame, policies: dict[int, int] = POLICIES) -> DataFrame:
    """For each policy and rule: documents that fail the rule, that fail it alone, and
    that the policy keeps with and without it.

    Rows are reduced to one count for each pattern of bits first (a map-side sum); there are
    2^rules patterns at most, whatever the number of documents."""
    patterns = ledger_rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    masks = F.array(*(F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask")) for v, m in policies.items()))
    bits = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << b).cast("long").alias("bit")) for b, name, _ in RULES))
    each = patterns.select("fail_bits", "n", F.explode(masks).alias("p")).select("fail_bits", "n", "p.*", F.explode(bits).alias("r")) \
        .select("fail_bits", "n", "policy", "mask", "r.*").filter("mask & bit != 0")
    count = lambda when: F.sum(F.when(F.expr(when), F.col("n")).otherwise(0)).alias
    return each.groupBy("policy", "rule").agg(
        count("fail_bits & bit != 0")("failed"), count("fail_bits & mask = bit")("failed_alone"),
        count("fail_bits & mask = 0")("kept"), count("fail_bits & mask & ~bit = 0")("kept_without"))


def ever_failed(ledger_rows: DataFrame, *by: str) -> DataFrame:
    """Which rules some document, and which all documents, of a group fail (bit sets)."""
    return ledger_rows.groupBy(*by).agg(F.bit_or("fail_bits").alias("some"), F.bit_and("fail_bits").alias("all"))
