"""Dataset checks. Each returns its findings as a DataFrame; an empty one, or a
zero count, means the rule holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold
from ..schemas import Constraints
from ..session import materialize


class QualityError(ValueError):
    """A table broke its constraints; ``counts`` maps each broken rule to its rows."""

    def __init__(self, table: str, counts: dict[str, int]):
        self.table, self.counts = table, counts
        super().__init__(f"{table}: " + "; ".join(f"{rule}: {n}" for rule, n in sorted(counts.items())))


def comparable(df: DataFrame, column: str) -> Column:
    """The column as it takes part in equality: text without regard to case."""
    c = F.col(column)
    return fold(c) if isinstance(df.schema[column].dataType, T.StringType) else c


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, or incomplete, with their row counts."""
    grouped = df.groupBy(*[comparable(df, c).alias(c) for c in cols]).agg(F.count(F.lit(1)).alias("n_rows"))
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return grouped.where((F.col("n_rows") > 1) | incomplete)


def check_fk(child: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Child values without a parent, with their row counts; NULL passes.

    The child is reduced to one row per value first, so a value that fills much
    of the table costs the join one row.
    """
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(comparable(child, column).alias(column))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return used.join(parent.select(comparable(parent, parent_column).alias(column)), column, "left_anti")


def check_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Violations of every rule in one pass over the table: rows (rule, violations)."""
    counts = [F.expr(f"count_if(NOT coalesce({p}, true)) AS r{i}") for i, p in enumerate(rules.values())]
    pairs = ", ".join(f"struct('{name}' AS rule, r{i} AS violations)" for i, name in enumerate(rules))
    return df.agg(*counts).selectExpr(f"inline(array({pairs}))")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return check_rules(df, {c: f"{c} IS NOT NULL" for c in cols})


def check_expr(df: DataFrame, name: str, predicate: str) -> DataFrame:
    return check_rules(df, {name: predicate})


def check_domain(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the domain (blanks and case aside) with their row counts."""
    known = F.lower(F.trim(column)).isin([v.lower() for v in values])
    return df.where(~known).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def check_grain(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Key combinations that occur on more than one row."""
    grouped = df.groupBy(*[c.alias(name) for name, c in keys.items()])
    return grouped.agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def check_count(df: DataFrame, expected: DataFrame | int) -> DataFrame:
    """One row: rows found, rows expected, and whether they agree."""
    wanted = F.lit(expected) if isinstance(expected, int) else expected.agg(F.count(F.lit(1))).scalar()
    found = df.agg(F.count(F.lit(1)).alias("found"))
    return found.withColumn("expected", wanted.cast("bigint")).withColumn(
        "agrees", F.col("found") == F.col("expected")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


Checked = Mapping[str, tuple[DataFrame, Constraints]]


def audit(df: DataFrame, constraints: Constraints, parents: Mapping[str, DataFrame]) -> DataFrame:
    """All constraints of one table: lines (rule, violations), zero where a rule holds."""
    return audit_tables({"": (df, constraints)}, parents).drop("table_name")


def audit_tables(
    tables: Checked, parents: Mapping[str, DataFrame], rows: bool = True, keys: bool = True, references: bool = True
) -> DataFrame:
    """Constraints of some tables: lines (table_name, rule, violations), zero where a rule holds.

    Every table is scanned once. A row gives one line per key and per reference, with
    the compared value, and one without a value per row rule that it breaks. Lines are
    counted by domain and value: a key or row rule is a domain of its own, and all
    references to a column share one, in which the parent's rows have lines too. So a
    single shuffle, after a count in every task, brings all that bears on a value together.
    """
    rules: list[tuple[str, str]] = []
    domains: list[list[int]] = []  # the rules of each domain
    of: dict[tuple[str, str], int] = {}
    lines = []

    def enter(table: str, name: str, domain: int | None = None) -> tuple[int, int]:
        if domain is None:
            domain = len(domains)
            domains.append([])
        domains[domain].append(len(rules))
        rules.append((table, name))
        return domain, len(domains[domain]) - 1

    refs = [(df, ref) for df, c in tables.values() for ref in (c.references if references else ())]
    numeric = {}
    for df, ref in refs:
        both = _is_whole(df, ref.column) and _is_whole(parents[ref.parent], ref.parent_column)
        numeric[ref.parent, ref.parent_column] = both and numeric.get((ref.parent, ref.parent_column), True)
    for table, (df, c) in tables.items():
        parts = []
        for name, predicate in (c.row_rules() if rows else {}).items():
            parts.append(F.when(~F.coalesce(F.expr(predicate), F.lit(True)), _line(*enter(table, name))))
        for name, cols in (c.key_rules() if keys else {}).items():
            whole = len(cols) == 1 and _is_whole(df, cols[0])
            parts.append(_line(*enter(table, name), **_value(df, cols, whole)))
        for ref in c.references if references else ():
            to = (ref.parent, ref.parent_column)
            domain, slot = enter(table, f"{ref.column} in {ref.parent}", of.get(to))
            of[to] = domain
            parts.append(_line(domain, slot, **_value(df, [ref.column], numeric[to])))
        if parts:
            lines.append(df.select(F.inline(F.array_compact(F.array(*parts)))))
    for (parent, column), domain in of.items():
        key = _value(parents[parent], [column], numeric[parent, column])
        lines.append(parents[parent].select(F.inline(F.array(_line(domain, -1, **key)))))
    slots = range(max(map(len, domains)))
    counts = [F.count_if(F.col("slot") == s).alias(f"n{s}") for s in slots]
    values = reduce(DataFrame.unionByName, lines).groupBy("domain", "number", "text").agg(
        F.max(F.col("slot") == -1).alias("found"), *counts
    )
    missing = F.col("number").isNull() & F.col("text").isNull()
    repeated = missing | (F.col("n0") > 1)
    # no reference at all leaves no domain of one
    orphaned = F.col("domain").isin(*of.values()) if of else F.lit(False)
    broken = values.where(F.when(orphaned, ~missing & ~F.col("found")).otherwise(repeated))
    sums = broken.groupBy("domain").agg(*[F.sum(f"n{s}").alias(f"n{s}") for s in slots])
    by_slot = F.array(*[F.struct(F.lit(s).alias("slot"), F.col(f"n{s}").alias("n")) for s in slots])
    rule = F.element_at(F.element_at(F.array(*[F.array(*map(F.lit, d)) for d in domains]), F.col("domain") + 1), F.col("slot") + 1)
    width = F.element_at(F.array(*[F.lit(len(d)) for d in domains]), F.col("domain") + 1)
    found = sums.select("domain", F.inline(by_slot)).where(F.col("slot") < width).select(rule.alias("rule"), "n")
    none = values.sparkSession.range(len(rules)).select(F.col("id").cast("int").alias("rule"), F.lit(0).cast("bigint").alias("n"))
    totals = found.unionByName(none).groupBy("rule").agg(F.sum("n").alias("violations"))
    names = F.element_at(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(r).alias("r")) for t, r in rules]), F.col("rule") + 1)
    return totals.select(names["t"].alias("table_name"), names["r"].alias("rule"), "violations")


def _line(domain: int, slot: int, number: Column | None = None, text: Column | None = None) -> Column:
    values = ((number, "bigint"), (text, "string"))
    return F.struct(
        F.lit(domain).alias("domain"),
        F.lit(slot).alias("slot"),
        *[(F.lit(None) if v is None else v).cast(kind).alias(name) for name, (v, kind) in zip(("number", "text"), values)],
    )


def _is_whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _value(df: DataFrame, cols: Sequence[str], whole: bool) -> dict[str, Column]:
    return {"number": F.col(cols[0])} if whole else {"text": _text_key(df, cols)}


def _text_key(df: DataFrame, cols: Sequence[str]) -> Column:
    """The compared value of one or more columns as one text; NULL if any is NULL."""
    parts = [comparable(df, c).cast("string") for c in cols]
    if len(parts) == 1:
        return parts[0]
    if all(_is_whole(df, c) for c in cols):
        return F.concat(parts[0], *[p for part in parts[1:] for p in (F.lit(" "), part)])
    return F.when(F.forall(F.array(*parts), lambda p: p.isNotNull()), F.to_json(F.array(*parts)))


def summed(findings: DataFrame, rule: str) -> DataFrame:
    return findings.agg(F.expr("coalesce(sum(n_rows), 0L) AS violations")).selectExpr(f"'{rule}' AS rule", "violations")


# A value's rows are dealt over so many tasks when they are tagged.
SALTS = 16
# Values of one rule (some 100 bytes each in memory, besides their text) that are sent to every task, and the bytes of
# their texts: the driver holds them all.
FEW = 200_000
FEW_BYTES = 16 << 20


def tag_violations(
    df: DataFrame, constraints: Constraints, parents: Mapping[str, DataFrame], folder: str | None = None
) -> DataFrame:
    """Every row with ``violations``, the names of the rules it breaks.

    Rows meet the repeated and the orphaned values. These are written and counted
    first: up to ``FEW``, of ``FEW_BYTES`` at most, are sent to the rows, which stay where
    they are. More of them meet the rows in a shuffle; one value may be that of a third of all rows, so rows
    carry a salt (a hash of the whole row) and each value comes once per salt.
    """
    failed = [F.expr(f"if(coalesce({p}, true), NULL, '{name}')") for name, p in constraints.row_rules().items()]
    tagged = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    for i, (name, cols) in enumerate(constraints.key_rules().items()):
        match = [f"_k{i}_{j}" for j in range(len(cols))]
        values = check_unique(df, cols).select(*[F.col(c).alias(m) for c, m in zip(cols, match)], F.lit(True).alias(f"_dup{i}"))
        on = reduce(lambda a, b: a & b, [comparable(df, c).eqNullSafe(F.col(m)) for c, m in zip(cols, match)])
        tagged = _with_values(tagged, materialize(values, "repeated", folder), on).drop(*match, "_of")
        failed.append(F.when(F.col(f"_dup{i}"), F.lit(name)))
    for i, ref in enumerate(constraints.references):
        values = check_fk(df, parents[ref.parent], ref.column, ref.parent_column).select(
            F.col(ref.column).alias(f"_f{i}"), F.lit(True).alias(f"_orphan{i}")
        )
        on = comparable(df, ref.column) == F.col(f"_f{i}")
        tagged = _with_values(tagged, materialize(values, "orphans", folder), on).drop(f"_f{i}", "_of")
        failed.append(F.when(F.col(f"_orphan{i}"), F.lit(f"{ref.column} in {ref.parent}")))
    return tagged.select(*df.columns, F.array_compact(F.array(*failed)).alias("violations"))


def _with_values(rows: DataFrame, values: DataFrame, on: Column) -> DataFrame:
    texts = [F.octet_length(f.name) for f in values.schema.fields if isinstance(f.dataType, T.StringType)]
    text = reduce(lambda a, b: a + b, [F.coalesce(F.sum(t), F.lit(0)) for t in texts], F.lit(0))
    n, size = values.agg(F.count(F.lit(1)), text).first()
    if n <= FEW and size <= FEW_BYTES:
        return rows.join(F.broadcast(values), on, "left")
    salted = values.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # a plan counts the stored values once, not once per salt, and would broadcast them all
    return rows.join(salted.hint("merge"), on & (F.col("_salt") == F.col("_of")), "left")


def apply_rules(
    df: DataFrame,
    table: str,
    constraints: Constraints,
    parents: Mapping[str, DataFrame],
    policy: str = "fail",
    folder: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split into (good, bad) rows; ``bad`` carries the names of the broken rules.

    ``fail`` raises on the first load with any bad row, as a strict database
    would refuse the insert. ``quarantine`` keeps the good rows and hands back
    the bad ones whole. The tagged rows are written once, to ``folder`` if given.
    """
    if policy not in ("fail", "quarantine"):
        raise ValueError(f"unknown policy {policy!r}")
    if policy == "fail":
        # one row per broken rule
        broken = audit(df, constraints, parents).where("violations > 0").collect()
        if broken:
            raise QualityError(table, {r["rule"]: r["violations"] for r in broken})
        return df, df.where("false").withColumn("violations", F.array().cast("array<string>"))
    tagged = materialize(tag_violations(df, constraints, parents, folder), f"tagged-{table}", folder)
    clean = F.size("violations") == 0
    return tagged.where(clean).drop("violations"), tagged.where(~clean)
