"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

All of it is Spark SQL. A pattern's places come from splitting the text at its
matches: lengths of the parts and of the matches add up to code point offsets.
For the entropy scan a window of ``WINDOW`` characters runs along each candidate;
the counts of its characters change by one in and one out per step, and so does
the sum of c * log2(c) from which the entropy follows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let

# Kinds in their order, patterns, and the least characters of a match (of its value).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run of at least 20: shorter runs hold no longer one
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
# Candidates that are no secrets: without a digit, without a letter, or paths of words.
ALLOWED = (r"^[^0-9]*$", r"^[^A-Za-z]*$", r"^[a-z]+([-_/=+][a-z0-9]{1,12})+$")
ONE_DIGIT = r"^[A-Za-z]*[0-9][A-Za-z]*$"  # a word with a number
# A window that holds one of these whole does not count.
PLACEHOLDER = r"(?i:example|x{6}|0{6}|123456|abcdef)"
# Character classes of candidate strings, the bits a window must reach (20 different characters have 4.32; fewer
# symbols give fewer bits) and what each allows or leaves to a class before it.
CLASSES = (
    ("hexadecimal", r"(?<![A-Za-z0-9+/_=-])[0-9a-fA-F]{20,}(?![A-Za-z0-9+/_=-])", 3.0, ALLOWED),
    ("one case", r"(?<![A-Za-z0-9+/_=-])(?:[a-z0-9]{20,}|[A-Z0-9]{20,})(?![A-Za-z0-9+/_=-])", 3.5, (*ALLOWED, ONE_DIGIT, r"^[0-9a-f]+$", r"^[0-9A-F]+$")),
    ("alphanumeric", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}", 3.8, (*ALLOWED, r"^[0-9a-fA-F]+$", r"^[a-z0-9]+$", r"^[A-Z0-9]+$")),
)
# The symbols whose counts each class keeps.
SYMBOLS = {"hexadecimal": "0123456789abcdefABCDEF", "one case": "0123456789abcdefghijklmnopqrstuvwxyz"}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

CHUNK = 256


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each of some whole numbers ``join`` of all before it, 0 for the first.

    An array that grows step by step is copied at each step, so steps are taken in
    chunks, and over the chunks.
    """

    def steps(xs: Column, start: Column) -> Column:
        return F.aggregate(xs, F.array(start), lambda acc, x: F.concat(acc, F.array(join(F.element_at(acc, -1), x))))

    def chunked(xs: Column) -> Column:
        last = F.greatest(F.call_function("div", F.size(xs) - 1, F.lit(CHUNK)).cast("int"), F.lit(0))
        chunks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(xs, k * CHUNK + 1, CHUNK))
        return let(chunks, over)

    def over(chunks: Column) -> Column:
        starts = steps(F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, x: join(a, x))), F.lit(0))
        each = F.zip_with(chunks, F.slice(starts, 1, F.size(chunks)), lambda c, s: F.slice(steps(c, s), 1, F.size(c)))
        return F.flatten(each)

    return let(values, chunked)


def matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """``start, end, own, value`` of the leftmost non-overlapping matches: places, text, and length of a group."""
    regex = F.lit(pattern)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    values = F.regexp_extract_all(text, regex, F.lit(value_group))
    steps = F.zip_with(
        F.zip_with(F.split(text, pattern, -1), found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("own"))),
        values,
        lambda s, v: F.struct(s["gap"].alias("gap"), s["own"].alias("own"), F.length(v).alias("value")),
    )
    # the last part has no match after it
    steps = F.filter(steps, lambda s: s["own"].isNotNull())

    def placed(steps: Column) -> Column:
        before = running(F.transform(steps, lambda s: s["gap"] + F.length(s["own"])), lambda a, b: a + b)
        return F.zip_with(
            steps,
            before,
            lambda s, at: F.struct(
                (at + s["gap"]).alias("start"), (at + s["gap"] + F.length(s["own"])).alias("end"), s["own"].alias("own"), s["value"].alias("value")
            ),
        )

    none = F.array().cast("array<struct<start:int,end:int,own:string,value:int>>")
    return F.when(text.rlike(pattern), let(steps, placed)).otherwise(none)


def _span(m: Column, kind: int) -> Column:
    return F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))


def places(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 0) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``value_group`` has ``least`` characters or more."""
    kept = F.filter(matches(text, pattern, value_group), lambda m: m["value"] >= least)
    return F.transform(kept, lambda m: _span(m, kind))


def most_entropy(candidate: Column, symbols: str = ALPHABET) -> Column:
    """The greatest Shannon entropy, in bits, of ``WINDOW`` consecutive characters of ``candidate``.

    Windows that hold a placeholder whole are left out.
    """
    chars = F.filter(
        F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(symbols), c)), lambda c: c > 0
    )

    def term(c: Column) -> Column:
        return F.when(c > 0, c * F.log2(c)).otherwise(0.0)

    def step(acc: Column, x: Column) -> Column:
        # x: the character that enters and the one that leaves (0: none)
        counts = acc["counts"]
        into, out = x["into"], x["out"]
        now = F.element_at(counts, into) - F.when(into == out, 1).otherwise(0)
        was = F.when(out > 0, F.element_at(counts, F.greatest(out, F.lit(1)))).otherwise(0)
        total = acc["total"] - term(was) + F.when(was > 0, term(was - 1)).otherwise(0.0) - term(now) + term(now + 1)
        moved = F.transform(
            counts,
            lambda c, i: c + F.when(i + 1 == into, 1).otherwise(0) - F.when(i + 1 == out, 1).otherwise(0),
        )
        best = F.when((x["nth"] >= WINDOW) & ~x["held"], F.least(acc["best"], total)).otherwise(acc["best"])
        return F.struct(moved.alias("counts"), total.alias("total"), best.alias("best"))

    def pairs(chars: Column) -> Column:
        return F.transform(
            chars,
            lambda c, i: F.struct(
                c.alias("into"),
                F.when(i >= WINDOW, F.element_at(chars, F.greatest(i - WINDOW + 1, F.lit(1)))).otherwise(0).alias("out"),
                (i + 1).alias("nth"),
                F.exists(holes, lambda h: (h["start"] > i - WINDOW) & (h["end"] <= i + 1)).alias("held"),
            ),
        )

    holes = matches(candidate, PLACEHOLDER)

    start = F.struct(
        F.array_repeat(F.lit(0), len(symbols)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(1e9).alias("best"),
    )
    least = F.aggregate(let(chars, pairs), start, step)["best"]
    # H = log2(W) - sum(c * log2(c)) / W; a window that never filled has none
    return F.log2(F.lit(float(WINDOW))) - least / WINDOW


def entropy_places(text: Column) -> Column:
    """Spans of candidates with a window at or above its class's bits that no allow-list entry of the class fits."""
    found = []
    for name, pattern, bits, allow in CLASSES:
        allowed = F.lit("|".join(f"({p})" for p in allow))
        kept = F.filter(matches(text, pattern), lambda m: ~F.regexp_like(m["own"], allowed))  # noqa: B023
        folded = F.lower if name == "one case" else lambda own: own
        symbols = SYMBOLS.get(name, ALPHABET)
        kept = F.filter(kept, lambda m: most_entropy(folded(m["own"]), symbols) >= F.lit(bits))  # noqa: B023
        found.append(F.transform(kept, lambda m: _span(m, KINDS.index("entropy"))))
    return F.array_distinct(F.concat(*found))


def scan(docs: DataFrame, base_name: str = "_base", spans_name: str = "_spans") -> DataFrame:
    """``docs`` with two arrays of ``start, kind, end`` by start, then kind, ends exclusive: fixed patterns' and all spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.array_sort(
        F.concat(places(text, ASSIGN, 0, value_group=2, least=6), places(text, ACCESS, 1), places(text, HEX, 2))
    )
    return docs.withColumn(base_name, base).withColumn(spans_name, F.array_sort(F.concat(base_name, entropy_places(text))))


def written(spans: Column) -> Column:
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["kind"] + 1), s["start"], s["end"])), ","
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for every row, repeated rows and ids included.

    Null texts are empty. Spans of different kinds may overlap, and a span that two
    classes find is one.
    """
    found = scan(docs.select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(n).alias(f"n_{kind}") for n, kind in enumerate(KINDS[:3])],
        F.sha2(written(F.col("_base")), 256).alias("base_sha256"),
        written(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``, overlapping spans once; ``n_chars`` follows if there."""
    text = F.col("text")
    spans_name = free_name(docs, "_spans")
    found = scan(docs, free_name(docs, "_base"), spans_name)
    # how far earlier spans reach
    reached = running(F.transform(spans_name, lambda s: s["end"]), F.greatest)

    def part(s: Column, at: Column) -> Column:
        return F.when(s["start"] >= at, F.concat(text.substr(at + 1, s["start"] - at), F.lit(mark))).otherwise("")

    parts = F.array_join(F.zip_with(spans_name, reached, part), "")
    rest = text.substr(F.array_max(F.transform(spans_name, lambda s: s["end"])) + 1, F.length(text))
    clean = found.withColumn("text", F.when(F.size(spans_name) > 0, F.concat(parts, rest)).otherwise(text))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)
