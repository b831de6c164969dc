"""Secrets in texts: fixed patterns, and stretches of high entropy.

Everything is a chain of SQL functions inside one scan: no shuffle, no Python worker.

Patterns (``PATTERNS``): the matches of each kind, leftmost first and without overlap; matches that
are too short are dropped after matching, so they still use up the text they cover.

Entropy: candidate strings are the runs of at least ``window`` characters of ``CANDIDATE``. A window
slides over each; the sum of c * log2(c) over its symbol counts follows from the two counts that a step
changes, so a step costs the same however long the string is. The sum is kept in whole units of
2^-20 bits, so it never drifts. The window's Shannon entropy is log2(window) less that sum over the
window, and must reach the limit of the candidate's character class (``CLASSES``, the first that fits).
Hot windows that touch become one span. Candidates that match a pattern of ``ALLOWED`` as a whole give
none; pattern matches always stay.

Offsets are code points, ends exclusive. Positions come from the lengths of matches and of the text
between them, added up in blocks, so a text with very many matches costs little more than its length.

Defined cases: a null or empty text has no spans; rows that repeat a key are scanned each for
themselves; input columns whose name is also a new column are replaced; an empty table stays empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import fresh

# Kinds in order, their patterns, which group counts and how long it must be.
PATTERNS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),  # as maximal runs, so that shorter ones are not even listed
]

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]"
#: Kind, what all characters of a candidate must be, and bits a window must reach (20 different
#: symbols give 4.32 bits). Random hex digits reach about 3.3, random base64 about 4.1; runs of
#: letters alone must be next to free of repeats.
CLASSES = [
    ("entropy_digits", r"^[0-9]+$", 3.2),
    ("entropy_hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.1),
    ("entropy_letters", r"^[A-Za-z]+$", 4.1),
    ("entropy_mixed", r"", 3.8),
]
#: Candidates that are no secrets: UUIDs, lower-case words joined by signs, paths, sample values.
ALLOWED = [
    r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"/?[A-Za-z]+(?:[-_/=+][A-Za-z]+)+/?",
    r".*(?i:example|placeholder|changeme|0123456789|abcdefghij).*",
]

UNIT = 1 << 20      # entropy sums are whole multiples of 2^-20 bits
BLOCK = 256         # offsets are added up within blocks, then over blocks
STRETCH = 2048      # windows handled per string, so that long candidates are many short ones
SPAN = "struct<start:bigint,kind:int,end:bigint>"


def weight(count: int) -> int:
    """count * log2(count) in units."""
    return round(count * math.log2(count) * UNIT) if count else 0


def most(bits: float, window: int) -> int:
    """The largest sum of weights with which a window still has ``bits`` of entropy."""
    return math.floor((math.log2(window) - bits) * window * UNIT)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + x)


def _numbers(n: Column) -> Column:
    """0 to n - 1; nothing for n = 0."""
    return F.slice(F.sequence(F.lit(0), n), F.lit(1), n)


def before(lengths: Column) -> Column:
    """For every element of an array of numbers the sum of those before it."""
    none = F.array().cast("array<bigint>")
    blocks = F.transform(_numbers(F.ceil(F.size(lengths) / F.lit(BLOCK)).cast("int")),
                         lambda b: F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("all"))

    def running(a: Column, first: Column) -> Column:
        return F.aggregate(a, F.struct(first.alias("at"), none.alias("all")), lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")), lambda s: s["all"])

    firsts = F.aggregate(blocks, start, lambda s, b: F.struct(
        (s["at"] + _sum(b)).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")), lambda s: s["all"])
    return F.flatten(F.zip_with(blocks, firsts, running))


def _long(a: Column) -> Column:
    return F.transform(a, lambda s: F.char_length(s).cast("bigint"))


def _matches(found: Column, pieces: Column) -> Column:
    """All matches as an array of (start, text), from the matches and the text split at them."""
    gaps = _long(F.slice(pieces, F.lit(1), F.size(found)))
    # a match begins behind all earlier ones with what lies in front of each, and its own gap
    starts = F.zip_with(before(F.zip_with(_long(found), gaps, lambda m, g: m + g)), gaps, lambda at, g: at + g)
    return F.zip_with(starts, found, lambda at, m: F.struct(at.alias("start"), m.alias("text")))


def _spans(found: Column, number: int, pattern: str, group: int, least: int) -> Column:
    """Matches that are long enough, as spans of kind ``number``."""
    kept = F.filter(found, lambda m: F.char_length(F.regexp_extract(m["text"], pattern, group)) >= least)
    return F.transform(kept, lambda m: F.struct(
        m["start"].alias("start"), F.lit(number).alias("kind"), (m["start"] + F.char_length(m["text"])).alias("end"))).cast(f"array<{SPAN}>")


def _class(text: Column, first: int, classes: list[tuple[str, str, float]]) -> Column:
    out = F.lit(first + len(classes) - 1)
    for k in reversed(range(len(classes) - 1)):
        out = F.when(text.rlike(classes[k][1]), F.lit(first + k)).otherwise(out)
    return out


def stretches(found: Column, first: int, classes, allowed, window: int) -> Column:
    """Candidates that are not allowed, cut into strings that each hold ``STRETCH`` window starts,
    as (start, kind, text)."""
    kept = F.filter(found, lambda m: ~m["text"].rlike("^(?:" + "|".join(f"(?:{a})" for a in allowed) + ")$")) if allowed else found
    named = F.transform(kept, lambda m: F.struct(m["start"].alias("start"), _class(m["text"], first, classes).alias("kind"), m["text"].alias("text")))
    return F.flatten(F.transform(named, lambda m: F.transform(
        _numbers(F.ceil((F.char_length(m["text"]) - (window - 1)) / F.lit(STRETCH)).cast("int")),
        lambda j: F.struct((m["start"] + j * STRETCH).alias("start"), m["kind"].alias("kind"),
                           F.substring(m["text"], j * STRETCH + 1, F.lit(STRETCH + window - 1)).alias("text")))))


def hot(stretch: Column, first: int, classes, window: int) -> Column:
    """The spans of a stretch whose windows reach the limit of its kind.

    The state holds the window's counts as one string with a character per symbol (its code is the
    count, shifted to printable signs), the sum of weights, and the spans so far, the last one open.
    """
    zero, low, high = 48, 43, 122  # codes of the sign for a count of 0, and of the first and last symbol
    steps = F.array(*[F.lit(weight(c + 1) - weight(c)) for c in range(window)])
    limit = F.element_at(F.array(*[F.lit(most(bits, window)) for _, _, bits in classes]), stretch["kind"] - first + 1)
    none = F.array().cast(f"array<{SPAN}>")
    start = F.struct(F.lit(chr(zero) * (high - low + 1)).alias("counts"), F.lit(0).cast("bigint").alias("sum"), none.alias("spans"))

    def symbol(i: Column) -> Column:
        return F.ascii(F.substring(stretch["text"], i, F.lit(1))) - (low - 1)

    def held(counts: Column, s: Column) -> Column:
        return F.ascii(F.substring(counts, s, F.lit(1))) - zero

    def put(counts: Column, s: Column, n: Column) -> Column:
        return F.overlay(counts, F.char(n + zero), s, F.lit(1))

    def leave(state: Column, i: Column) -> Column:
        gone = symbol(i - window)
        n = held(state["counts"], gone)
        return F.when(i <= window, state).otherwise(F.struct(
            put(state["counts"], gone, n - 1).alias("counts"), (state["sum"] - F.element_at(steps, n)).alias("sum"), state["spans"].alias("spans")))

    def enter(state: Column, i: Column) -> Column:
        new = symbol(i)
        n = held(state["counts"], new)
        return F.struct(put(state["counts"], new, n + 1).alias("counts"), (state["sum"] + F.element_at(steps, n + 1)).alias("sum"),
                        state["spans"].alias("spans"))

    def note(state: Column, i: Column) -> Column:
        end = stretch["start"] + i
        last = F.try_element_at(state["spans"], F.lit(-1))
        touches = F.coalesce(last["end"] >= end - window, F.lit(False))
        grown = F.concat(F.slice(state["spans"], F.lit(1), F.greatest(F.size(state["spans"]) - 1, F.lit(0))), F.array(F.struct(
            F.when(touches, last["start"]).otherwise(end - window).alias("start"), stretch["kind"].alias("kind"), end.alias("end"))).cast(f"array<{SPAN}>"))
        apart = F.concat(state["spans"], F.array(F.struct((end - window).alias("start"), stretch["kind"].alias("kind"), end.alias("end"))).cast(f"array<{SPAN}>"))
        return F.when((i >= window) & (state["sum"] <= limit), F.struct(
            state["counts"].alias("counts"), state["sum"].alias("sum"),
            F.when(touches, grown).otherwise(apart).alias("spans"))).otherwise(state)

    def step(state: Column, i: Column) -> Column:
        return _let(_let(leave(state, i), lambda s: enter(s, i)), lambda s: note(s, i))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(stretch["text"])), start, step, lambda s: s["spans"])


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def joined(spans: Column) -> Column:
    """Spans in order, those that touch as one; only stretches of one candidate can touch."""
    firsts = F.filter(spans, lambda s, i: (i == 0) | (F.coalesce(F.get(spans, i - 1)["end"], F.lit(-1)) < s["start"]))
    lasts = F.filter(spans, lambda s, i: F.coalesce(F.get(spans, i + 1)["start"] > s["end"], F.lit(True)))
    return F.zip_with(firsts, lasts, lambda a, b: F.struct(a["start"].alias("start"), a["kind"].alias("kind"), b["end"].alias("end"))).cast(f"array<{SPAN}>")


def scan(docs: DataFrame, text: str = "text", patterns=None, classes=None, allowed=None, window: int = WINDOW,
         prefix: str = "") -> DataFrame:
    """``docs`` with ``pattern_spans`` and ``entropy_spans``: sorted arrays of (start, kind, end), where
    kind counts ``kinds(patterns, classes)`` from 1. ``prefix`` is put before the new names.

    Every step is a projection of its own, so that no long array is computed twice.
    """
    patterns, classes = PATTERNS if patterns is None else patterns, CLASSES if classes is None else classes
    allowed = ALLOWED if allowed is None else allowed
    first = len(patterns) + 1
    new = [prefix + "pattern_spans", prefix + "entropy_spans"]
    carried = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in new]
    own = fresh(docs, prefix + "secret_")
    searched = [p[1] for p in patterns] + [CANDIDATE + "{%d,}" % window]
    out = docs.select(*carried, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(own))
    out = out.select(*carried, own, *[F.regexp_extract_all(own, F.lit(p), F.lit(0)).alias(f"{own}m{k}") for k, p in enumerate(searched)])
    out = out.select(*carried, *[c for k, p in enumerate(searched) for c in (  # few texts have any match
        F.col(f"{own}m{k}"), F.when(F.size(f"{own}m{k}") > 0, F.split(own, p, -1)).otherwise(F.array()).alias(f"{own}g{k}"))])
    out = out.select(*carried, *[_matches(F.col(f"{own}m{k}"), F.col(f"{own}g{k}")).alias(f"{own}f{k}") for k in range(len(searched))])
    out = out.select(*carried, F.array_sort(F.concat(*[
        _spans(F.col(f"{own}f{k}"), k + 1, p, group, least) for k, (_, p, group, least) in enumerate(patterns)])).alias(new[0]),
        stretches(F.col(f"{own}f{len(patterns)}"), first, classes, allowed, window).alias(own))
    out = out.select(*carried, new[0], F.flatten(F.transform(own, lambda s: hot(s, first, classes, window))).alias(own))
    return out.select(*carried, new[0], joined(F.col(own)).alias(new[1]))


def kinds(patterns=None, classes=None) -> list[str]:
    return [p[0] for p in (PATTERNS if patterns is None else patterns)] + [c[0] for c in (CLASSES if classes is None else classes)]


def written(spans: Column, names: list[str] | None = None) -> Column:
    """Spans as comma-joined kind:start:end."""
    names = F.array(*[F.lit(n) for n in names or kinds()])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "*", text: str = "text", **options) -> DataFrame:
    """``docs`` with every character of a span replaced by ``mark``; all columns stay."""
    if len(mark) != 1:
        raise ValueError("mark is one character")
    new = fresh(docs, "found_")
    all_spans = F.array_sort(F.concat(new + "pattern_spans", new + "entropy_spans"))
    hidden = F.aggregate(all_spans, F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts")), lambda s, x: F.when(
        x["end"] <= s["at"], s).otherwise(F.struct(x["end"].alias("at"), F.concat(s["parts"], F.array(
            F.substring(F.col(f"`{text}`"), (s["at"] + 1).cast("int"), F.greatest(x["start"] - s["at"], F.lit(0)).cast("int")),
            F.repeat(F.lit(mark), (x["end"] - F.greatest(x["start"], s["at"])).cast("int")))).alias("parts"))),
        lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(F.col(f"`{text}`"), (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    scanned = scan(docs, text, prefix=new, **options)
    return scanned.select(*[F.when(F.size(all_spans) > 0, hidden).otherwise(F.col(f"`{c}`")).alias(c) if c == text else F.col(f"`{c}`")
                            for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: matches by kind, a digest of them, and all spans."""
    found = scan(docs.select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("pattern_spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", *[count(k + 1).alias(f"n_{name}") for k, (name, *_) in enumerate(PATTERNS)],
        F.sha2(written(F.col("pattern_spans")).cast("binary"), 256).alias("base_sha256"),
        written(F.array_sort(F.concat("pattern_spans", "entropy_spans"))).alias("spans"))


def _sql() -> str:
    """The report for one document per row number, windows counted one by one."""
    def positions(name: str, pattern: str) -> str:
        return (f"{name}_m AS (SELECT r, i, m, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i) - length(m) AS s FROM ("
                f"SELECT r, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g FROM ("
                f"SELECT r, regexp_extract_all(t, $p${pattern}$p$, 0) AS ms, string_split_regex(t, $p${pattern}$p$) AS gs FROM docs)))")

    parts, bases = [], []
    for k, (name, pattern, group, least) in enumerate(PATTERNS):
        parts.append(positions(name, pattern))
        bases.append(f"SELECT r, s, {k + 1} AS k, s + length(m) AS e FROM {name}_m WHERE length(regexp_extract(m, $p${pattern}$p$, {group})) >= {least}")
    first = len(PATTERNS) + 1
    kind = " ".join(f"WHEN regexp_matches(m, $p${p}$p$) THEN {first + k}" for k, (_, p, _) in enumerate(CLASSES) if p)
    limit = " ".join(f"WHEN {first + k} THEN {most(bits, WINDOW)}" for k, (_, _, bits) in enumerate(CLASSES))
    weights = ", ".join(str(weight(c)) for c in range(WINDOW + 1))
    allowed = "|".join(f"(?:{a})" for a in ALLOWED)
    parts.append(positions("cand", CANDIDATE + "{%d,}" % WINDOW))
    named = " ".join(f"WHEN {k + 1} THEN '{n}'" for k, n in enumerate(kinds()))
    counts = ", ".join(f"count(*) FILTER (k = {k + 1}) AS n_{n}" for k, (n, *_) in enumerate(PATTERNS))
    return f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
{', '.join(parts)},
base AS ({' UNION ALL '.join(bases)}),
cand AS (SELECT r, i, m, s, CASE {kind} ELSE {first + len(CLASSES) - 1} END AS k FROM cand_m WHERE NOT regexp_matches(m, $p$^(?:{allowed})$$p$)),
wins AS (SELECT r, i, k, s + j - 1 AS s, substring(m, j, {WINDOW}) AS w
         FROM (SELECT *, unnest(range(1, length(m) - {WINDOW} + 2)) AS j FROM cand)),
sums AS (SELECT r, i, k, s, sum(([{weights}])[c + 1]) AS x
         FROM (SELECT r, i, k, s, ch, count(*) AS c FROM (SELECT r, i, k, s, unnest(string_split(w, '')) AS ch FROM wins) GROUP BY ALL) GROUP BY ALL),
hot AS (SELECT * FROM sums WHERE x <= CASE k {limit} END),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY r, i ORDER BY s) AS g
         FROM (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY r, i ORDER BY s) <= {WINDOW} THEN 0 ELSE 1 END AS fresh FROM hot)),
found AS (SELECT r, s, k, e, true AS base FROM base
          UNION ALL SELECT r, min(s) AS s, k, max(s) + {WINDOW} AS e, false FROM runs GROUP BY r, i, k, g),
named AS (SELECT *, CASE k {named} END || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS w FROM found),
lists AS (SELECT r, {counts}, string_agg(w, ',' ORDER BY s, k, e) FILTER (base) AS b, string_agg(w, ',' ORDER BY s, k, e) AS a FROM named GROUP BY r)
SELECT doc_id, {', '.join(f'CAST(coalesce(n_{n}, 0) AS BIGINT) AS n_{n}' for n, *_ in PATTERNS)},
       sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM docs LEFT JOIN lists USING (r)
"""


REPORT_SQL = _sql()
