"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Everything is a column expression over the row's own text, so nothing is shuffled and
no Python runs.  Every pattern is written without nested repetition: separators
inside numbers and domains are first replaced, one for one, by a marker character
through look-around.  Java's matcher then never recurses, a match costs time linear in
the text, and positions stay those of the original.

Positions follow from the lengths of matches and of what lies between them.  The running
sums are taken in blocks of 256 matches, and masks are put in block by block, so that a text full of
matches does not cost their square.

Kinds: email, ip (parts to 255), card (16-19 digits, Luhn) and phone (8-15 digits) are
reported always; an IBAN must pass mod 97, and a social security number counts only
with a context word close before it.  The context of a span is what lies between it and
the match before, the last ``NEARBY`` characters of that.  If that has no letter or digit, the
two are of one list, and a social security number has the context of the one before.

What follows an IBAN may look like more of it, so every start is a proposal of its own, whatever
it overlaps, and ends after any of its words: the country's length is tried first, then the
longest.  Of confirmed spans that overlap the leftmost stays.

Cases: a null or empty text has no spans; spans of different kinds may overlap, those of
one kind never do; repeated rows and null ids are rows like any other; input columns
travel in a struct and cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "\x01"
BLOCK = 256
NEARBY = 40
THRESHOLD = 0.5


@dataclass(frozen=True)
class Kind:
    """pattern runs over the text in which ``mark`` (if any) has become MARK; ``valid`` is an
    expression over the match m and its digits d; scores add up to a decision."""

    name: str
    needs: str                  # a quick test that holds wherever the pattern could match
    mark: str | None
    pattern: str
    valid: str
    score: float
    words: str                  # context words, lower case, as alternatives
    bonus: float
    base: bool = True
    cut: str | None = None      # the part of m that counts, or null; group 1 of the pattern, seen ahead, is the rest of m


_LUHN = ("(length(d) BETWEEN 16 AND 19 AND aggregate(sequence(1, length(d)), 0, (s, i) -> s + CASE "
         "WHEN (length(d) - i) % 2 = 0 THEN int(substring(d, i, 1)) "
         "WHEN int(substring(d, i, 1)) > 4 THEN 2 * int(substring(d, i, 1)) - 9 "
         "ELSE 2 * int(substring(d, i, 1)) END) % 10 = 0)")
_MOD97 = ("aggregate(split(concat(substring(replace(c, ' ', ''), 5), substring(replace(c, ' ', ''), 1, 4)), ''), 0, "
          "(s, y) -> CASE WHEN y = '' THEN s WHEN y BETWEEN '0' AND '9' THEN (s * 10 + int(y)) % 97 "
          "ELSE (s * 100 + ascii(y) - 55) % 97 END) = 1")
#: Characters of an IBAN by country; other codes have any length.
IBAN_LENGTH = {n: countries.split() for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items()}
_LENGTH = "CASE " + " ".join(f"WHEN substring(m, 1, 2) IN ({', '.join(map(repr, c))}) THEN {n}" for n, c in IBAN_LENGTH.items()) + " ELSE 0 END"
# the words of a proposal, as ends that pass mod 97, longest first
_IBAN = ("get(transform(array(filter(transform(sequence(size(split(m, ' ')), 1, -1), i -> array_join(slice(split(m, ' '), 1, i), ' ')), "
         f"c -> length(replace(c, ' ', '')) >= 15 AND {_MOD97})), "
         f"e -> coalesce(get(filter(e, c -> length(replace(c, ' ', '')) = {_LENGTH}), 0), get(e, 0))), 0)")
KINDS = [
    Kind("email", "contains(t, '@')", r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])",
         r"(?:(?<![A-Za-z0-9._%+\x01-])|\G)[A-Za-z0-9._%+\x01-]++@[A-Za-z0-9-]++\x01[A-Za-z0-9\x01-]++",
         "true", 0.9, "mail|contact|write|kontakt|correo|courriel", 0.1),
    Kind("ip", r"t rlike '[0-9]\\.[0-9]'", None, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"m rlike '^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\\.|$)){4}$'",
         0.6, "ip|address|host|server|login|adresse", 0.3),
    Kind("card", r"t rlike '[0-9][0-9 -]{14}'", r"(?<=[0-9])[ -](?=[0-9])", r"[0-9][0-9\x01]++",
         _LUHN, 0.8, "card|visa|credit|karte|tarjeta|carte|payment", 0.2),
    Kind("phone", "contains(t, '+')", None, r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 8 AND 15",
         0.7, "call|phone|tel|mobile|fax|telefon", 0.2),
    Kind("iban", r"t rlike '[A-Z]{2}[0-9]{2}'", None,
         r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=((?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9]))", "true",
         0.9, "iban|account|konto|cuenta|compte", 0.1, False, _IBAN),
    Kind("ssn", r"t rlike '[0-9]{3}-[0-9]{2}-[0-9]{4}'", None,
         r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "true",
         0.3, "ssn|social security|tax id", 0.5, False),
]
BASE = [k.name for k in KINDS if k.base]


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _with_spans(df: DataFrame, *keep: str) -> DataFrame:
    """Adds ``spans``: array of (kind, start, end, score), by kind as listed, then start.
    ``df`` has the text as ``t``; places count code points, the end is exclusive."""
    kept = [*keep, "t"]
    # the marker itself may occur in a text: it gives way to another control character
    clean = "translate(t, '\x01', '\x02')"
    marked = lambda k: f"regexp_replace({clean}, {_quoted(k.mark)}, '\x01')" if k.mark else "t"
    found = df.select(*kept, *(F.expr(f"CASE WHEN {k.needs} THEN {marked(k)} END").alias(f"t_{k.name}") for k in KINDS))
    found = found.select(*kept, *(f"t_{k.name}" for k in KINDS), *(
        F.expr(f"CASE WHEN t_{k.name} IS NOT NULL THEN regexp_extract_all(t_{k.name}, {_quoted(k.pattern)}, 0) END").alias(f"m_{k.name}")
        for k in KINDS))
    full = lambda k: f"zip_with(m_{k.name}, regexp_extract_all(t_{k.name}, {_quoted(k.pattern)}, 1), (x, y) -> concat(x, y))" if k.cut else f"m_{k.name}"
    # between[i] precedes match[i]
    found = found.select(*kept, *(F.expr(f"""CASE WHEN size(m_{k.name}) > 0 THEN cast(arrays_zip(
            slice(split(t_{k.name}, {_quoted(k.pattern)}, -1), 1, size(m_{k.name})), m_{k.name}, {full(k)})
            AS array<struct<gap:string,m:string,full:string>>) END""").alias(f"z_{k.name}") for k in KINDS))
    span = "struct<start:bigint,end:bigint,m:string,near:string>"
    # in a list the context is that of the match before: null if that lies in an earlier block
    own = f"lower(right(x.gap, {NEARBY}))"
    near = lambda k: own if k.base or k.cut else f"CASE WHEN x.gap rlike '[\\\\p{{L}}\\\\p{{N}}]' THEN {own} WHEN size(a.s) > 0 THEN element_at(a.s, -1).near END"
    found = found.select(*kept, *(F.expr(f"""CASE WHEN z_{k.name} IS NOT NULL THEN
        transform(sequence(0, (size(z_{k.name}) - 1) div {BLOCK}), b -> aggregate(slice(z_{k.name}, b * {BLOCK} + 1, {BLOCK}),
            struct(0L AS n, cast(array() AS array<{span}>) AS s),
            (a, x) -> struct(a.n + length(x.gap) + length(x.m) AS n, concat(a.s, array(struct(
                a.n + length(x.gap) AS start, a.n + length(x.gap) + length(x.m) AS end, x.full AS m,
                {near(k)} AS near))) AS s))) END""").alias(f"b_{k.name}") for k in KINDS))
    shifted = "transform(x.s, y -> struct(y.start + a.n AS start, y.end + a.n AS end, y.m AS m, coalesce(y.near, a.near) AS near))"
    found = found.select(*kept, *(F.expr(f"""CASE WHEN b_{k.name} IS NOT NULL THEN flatten(aggregate(b_{k.name},
        struct(0L AS n, '' AS near, cast(array() AS array<array<{span}>>) AS s),
        (a, x) -> struct(a.n + x.n AS n, coalesce(element_at(x.s, -1).near, a.near) AS near, concat(a.s, array({shifted})) AS s)).s)
        ELSE cast(array() AS array<{span}>) END""").alias(f"s_{k.name}") for k in KINDS))
    # proposals that overlap: cut, then each that begins at or after the end of the last one kept
    cut = lambda k: (f"filter(transform(s_{k.name}, x -> struct(x.start AS start, get(transform(array(x.m), m -> {k.cut}), 0) AS m, x.near AS near)), "  # noqa: E731
                     "x -> x.m IS NOT NULL)")
    found = found.select(*kept, *(F.expr(cut(k) if k.cut else f"s_{k.name}").alias(f"s_{k.name}") for k in KINDS))
    late = "struct(x.start AS start, x.start + length(x.m) AS end, x.m AS m, x.near AS near)"
    found = found.select(*kept, *(F.expr(f"""CASE WHEN size(s_{k.name}) > 0 THEN flatten(aggregate(
        transform(sequence(0, (size(s_{k.name}) - 1) div {BLOCK}), b -> slice(s_{k.name}, b * {BLOCK} + 1, {BLOCK})),
        struct(0L AS n, cast(array() AS array<array<{span}>>) AS s),
        (r, z) -> get(transform(array(aggregate(z, struct(r.n AS n, cast(array() AS array<{span}>) AS s), (a, x) ->
            CASE WHEN x.start < a.n THEN a ELSE struct(x.start + length(x.m) AS n, concat(a.s, array({late})) AS s) END)),
            q -> struct(q.n AS n, concat(r.s, array(q.s)) AS s)), 0)).s)
        ELSE cast(array() AS array<{span}>) END""" if k.cut else f"s_{k.name}").alias(f"s_{k.name}") for k in KINDS))
    parts = []
    for k in KINDS:
        digits = "regexp_replace(x.m, '[^0-9]', '')"
        # m and d stand for the match and its digits: bound by an inner lambda
        valid = (f"exists(array(struct(x.m AS m, {digits} AS d)), v -> "
                 + k.valid.replace("(d)", "(v.d)").replace("(d,", "(v.d,").replace("m rlike", "v.m rlike").replace("(m,", "(v.m,") + ")")
        score = f"({k.score}D + CASE WHEN x.near rlike '(?:^|[^a-z])(?:{k.words})' THEN {k.bonus}D ELSE 0D END)"
        keeps = valid if k.base else f"{valid} AND {score} >= {THRESHOLD}D"
        parts.append(f"transform(filter(s_{k.name}, x -> {keeps}), x -> struct('{k.name}' AS kind, x.start AS start, "
                     f"x.end AS end, {score} AS score))")
    return found.select(*kept, F.expr(f"concat({', '.join(parts)})").alias("spans"))


def _joined(kinds: list[str] | None = None) -> str:
    spans = f"filter(spans, x -> x.kind IN ({', '.join(repr(k) for k in kinds)}))" if kinds else "spans"
    return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans (kind, start, end, score) of every document."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    return _with_spans(df, "doc_id").select("doc_id", "spans")


def digest(docs: DataFrame) -> DataFrame:
    found = find_pii(docs)
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = '{n}')) AS bigint) AS n_{n}") for n in BASE]
    return found.select("doc_id", *counts, F.sha2(F.expr(_joined(BASE)), 256).alias("base_sha256"), F.expr(_joined()).alias("spans"),
                        F.expr("coalesce(array_max(transform(spans, x -> x.score)), 0D)").alias("top_score"))


def redact(docs: DataFrame) -> DataFrame:
    """Every span becomes its kind in brackets (overlapping spans one mask); n_chars, if
    there is one, follows the new text.  A null text stays null."""
    columns = docs.columns
    df = docs.select(F.struct("*").alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    df = _with_spans(df, "row")
    # in blocks, as above: an interval stays open until one begins at or after its end
    interval = "struct<kind:string,start:bigint,end:bigint>"
    grown = "struct(a.open.kind AS kind, a.open.start AS start, greatest(a.open.end, x.end) AS end)"
    df = df.select("row", "t", F.expr("""transform(array_sort(transform(spans, x -> struct(x.start AS start, -x.end AS last, x.kind AS kind))),
        x -> struct(x.kind AS kind, x.start AS start, -x.last AS end))""").alias("s"))
    df = df.select("row", "t", F.expr(f"""CASE WHEN size(s) > 0 THEN aggregate(
        transform(sequence(0, (size(s) - 1) div {BLOCK}), b -> slice(s, b * {BLOCK} + 1, {BLOCK})),
        struct(cast(NULL AS {interval}) AS open, cast(array() AS array<array<{interval}>>) AS done),
        (r, z) -> get(transform(array(aggregate(z, struct(r.open AS open, cast(array() AS array<{interval}>) AS s), (a, x) ->
            CASE WHEN x.start < a.open.end THEN struct({grown} AS open, a.s AS s)
                 ELSE struct(x AS open, IF(a.open IS NULL, a.s, concat(a.s, array(a.open))) AS s) END)),
            q -> struct(q.open AS open, concat(r.done, array(q.s)) AS done)), 0),
        r -> concat(flatten(r.done), array(r.open))) ELSE cast(array() AS array<{interval}>) END""").alias("cut"))
    # a block's own stretch of text is cut out first, so that places count from its start
    piece = f"""get(transform(array(struct(slice(cut, int(b * {BLOCK} + 1), {BLOCK}) AS z, IF(b = 0, 0L, element_at(cut, int(greatest(1, b * {BLOCK}))).end) AS p)), y ->
        get(transform(array(substring(t, int(y.p + 1), int(element_at(y.z, -1).end - y.p))), c -> array_join(
            zip_with(y.z, concat(array(y.p), transform(slice(y.z, 1, size(y.z) - 1), x -> x.end)),
                     (x, q) -> concat(substring(c, int(q - y.p + 1), int(x.start - q)), '[', x.kind, ']')), '')), 0)), 0)"""
    new = F.expr(f"""CASE WHEN size(cut) = 0 THEN t ELSE concat(
        array_join(transform(sequence(0, (size(cut) - 1) div {BLOCK}), b -> {piece}), ''),
        substring(t, int(element_at(cut, -1).end + 1))) END""")
    df = df.select("row", F.when(F.col("row.text").isNotNull(), new).alias("new"))
    out = []
    for c in columns:
        if c == "text":
            out.append(F.col("new").alias("text"))
        elif c == "n_chars":
            kind = docs.schema["n_chars"].dataType
            out.append(F.when(F.col("row.n_chars").isNotNull(), F.length("new").cast(kind)).alias("n_chars"))
        else:
            out.append(F.col(f"row.`{c}`").alias(c))
    return df.select("row", "new").select(*out)
