"""Stored clean and star tables over a set of raw frames."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import order
from ..operators.quality import apply_rules
from ..schemas import CLEAN, LAYERS, STAR
from ..session import bound_broadcasts, bound_scans, delete_folder, materialize, shared_dir
from ..sources.keystore import KeyRegistry
from ..sources.tables import reset_layer, write_table
from . import dims, facts
from .clean import CLEANERS


class Layer(Mapping[str, DataFrame]):
    """Tables of a layer by name; each is loaded when first asked for."""

    def __init__(self, names: Mapping, load: Callable[[str], DataFrame]):
        self._names, self._load, self._tables = list(names), load, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            if name not in self._names:
                raise KeyError(name)
            self._tables[name] = self._load(name)
        return self._tables[name]

    def forget(self, name: str) -> None:
        """Load the table again when it is next asked for."""
        self._tables.pop(name, None)

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Warehouse:
    """Raw frames in, stored clean and star tables out.

    ``policy`` says what a broken constraint does to a load: ``"fail"`` refuses
    the table, as a strict database refuses the insert; ``"quarantine"`` keeps the
    good rows and stores the others under ``<root>/rejected``; ``None`` leaves
    checking to the validation queries. ``keys``, a stored registry, gives all
    surrogate keys, so they outlive any one load. ``buckets`` stores the subscription
    dimension and fact in so many buckets of their common key. Everything a
    warehouse writes lies under ``root``. The session's scan tasks and guessed
    broadcasts are kept small (``bound_scans``, ``bound_broadcasts``).
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        root: str | None = None,
        tag: str | None = None,
        policy: str | None = "fail",
        buckets: int | None = None,
        known: Warehouse | None = None,
        keys: KeyRegistry | None = None,
    ):
        self.spark, self.raw, self.policy, self.buckets, self.known = spark, raw, policy, buckets, known
        self.keys = keys
        bound_scans(spark)
        bound_broadcasts(spark)
        self.tag = tag if tag is not None else uuid.uuid4().hex[:8]
        self.root = root or f"{shared_dir(spark)}/warehouse-{self.tag}"
        self.clean = Layer(CLEAN, lambda name: self._store("clean", name, CLEANERS[name](self.raw[name])))
        self.star = Layer(STAR, self._load_star)
        self.rejected: dict[tuple[str, str], DataFrame] = {}
        self._bridge: DataFrame | None = None
        self._months: DataFrame | None = None

    def load_all(self) -> Warehouse:
        """Load everything, each table after those it refers to."""
        return self._load(order.load_order())

    def _load(self, names: list[str]) -> Warehouse:
        for name in names:
            (self.clean if name in CLEAN else self.star)[name]
        return self

    def refresh(self, raw: Mapping[str, DataFrame]) -> list[str]:
        """Load the tables of some new extracts again, and all that depend on them; returns their names in order."""
        self.raw = {**{t: self.raw[t] for t in self.raw}, **raw}
        names = order.dependents(raw)
        for name in names:
            (self.clean if name in CLEAN else self.star).forget(name)
        if "subscriptions" in names or "dim_account" in names:
            self._bridge = None
        self._load(names)
        return names

    def drop(self) -> None:
        """Drop the tables, their files, rejects, intermediate files and databases."""
        for layer in ("star", "clean"):
            reset_layer(self.spark, layer, self.tag, self.root)
        for folder in ("rejected", "stage"):
            delete_folder(self.spark, f"{self.root}/{folder}")

    def bridge(self) -> DataFrame:
        """Subscriptions with their keys, stored once: three tables are built from it."""
        if self._bridge is None:
            known = self.known.star["dim_subscription"] if self.known else None
            keyed = dims.subscription_bridge(self.clean["subscriptions"], self.star["dim_account"], known, self.keys)
            self._bridge = materialize(keyed, "bridge", f"{self.root}/stage")
        return self._bridge

    def _load_star(self, name: str) -> DataFrame:
        clean, star = self.clean, self.star
        build = {
            "dim_date": lambda: dims.build_dim_date(
                clean["subscriptions"], self.known.star["dim_date"] if self.known else None
            ),
            "dim_account": lambda: dims.load_dim_account(
                clean["accounts"], self.known.star["dim_account"] if self.known else None, self.keys
            ),
            "dim_subscription": lambda: dims.load_dim_subscription(self.bridge()),
            "dim_churn_reason": lambda: dims.load_dim_churn_reason(self.spark),
            "fact_subscriptions": lambda: facts.build_fact_subscriptions(self.bridge()),
            "fact_churn_events": lambda: facts.build_fact_churn_events(
                clean["churn_events"], star["dim_account"], star["dim_churn_reason"], self.keys
            ),
            "fact_subscription_usage": self._usage_fact,
        }
        return self._store("star", name, build[name]())

    def _usage_fact(self) -> DataFrame:
        """Where rejects are kept apart, the months are stored: those in the calendar go on to the trend, the others are refused."""
        usage, tickets = self.clean["feature_usage"], self.clean["support_tickets"]
        if self.policy != "quarantine":
            return facts.build_fact_subscription_usage(usage, tickets, self.bridge())
        self._months = materialize(facts.owned_months(usage, self.bridge()), "months", f"{self.root}/stage")
        return facts.months_within(self._months, tickets, self.star["dim_date"])

    def _store(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        constraints = LAYERS[layer][name]
        if self.policy:
            tables = self.clean if layer == "clean" else self.star
            parents = {ref.parent: tables[ref.parent] for ref in constraints.references}
            stage = f"{self.root}/stage"
            df = materialize(df, f"{layer}-{name}", stage)
            df, bad = apply_rules(df, name, constraints, parents, self.policy, stage)
            if self.policy == "quarantine":
                self.rejected[layer, name] = self._keep_rejects(layer, name, bad)
        return write_table(df, layer, name, self.root, tag=self.tag, **self._layout(name))

    def _keep_rejects(self, layer: str, name: str, bad: DataFrame) -> DataFrame:
        if name == "fact_subscription_usage":
            outside = facts.months_outside(self._months, self.clean["support_tickets"], self.star["dim_date"])
            bad = bad.unionByName(outside.withColumn("violations", F.array(F.lit("date_key in dim_date"))))
        path = f"{self.root}/rejected/{layer}/{name}"
        bad.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(bad.schema).parquet(path)

    def _layout(self, name: str) -> dict:
        """The usage fact is cut by month. With ``buckets`` the subscription dimension
        and fact share a bucketing by their common key: they join without a shuffle."""
        if name == "fact_subscription_usage":
            return {"partition_by": "date_key"}
        if self.buckets and name in ("dim_subscription", "fact_subscriptions"):
            return {"bucket_by": (self.buckets, "subscription_key")}
        return {}
