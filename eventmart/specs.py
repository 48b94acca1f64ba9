"""Feed descriptions: one control row per feed plus the key rules of its feed type."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart import fixed_values as fv
from eventmart.functions import require_columns


@dataclass(frozen=True)
class Link:
    """``columns`` of a feed must occur as ``other_columns`` of the feed type ``feed_type``."""

    feed_type: str
    columns: tuple[str, ...]
    other_columns: tuple[str, ...]


@dataclass(frozen=True)
class FeedRules:
    keys: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    links: tuple[Link, ...] = ()
    link_reason: str = fv.REASON_MISSING_PARENT
    modified: str = fv.MODIFIED
    aliases: Mapping[str, str] = field(default_factory=dict)
    file_pattern: str | None = None
    # Its links are to its children, which link back: it is checked first.
    parent: bool = False
    # Optional rules of the feed contract; empty means not checked.
    types: Mapping[str, str] = field(default_factory=dict)
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    dates: tuple[str, ...] = ()
    conditional: tuple[tuple[str, str, str], ...] = ()
    # (columns of the group, column, values): each group needs a row with one of the values.
    group: tuple[tuple[str, ...], str, tuple[str, ...]] | None = None


# The ready rules of the feed contract, by the name that a rules file can give.
CONTRACTS: dict[str, dict[str, object]] = {
    "event": {
        "types": fv.CONTRACT_TYPES,
        "domains": fv.CONTRACT_DOMAINS,
        "conditional": (fv.CHILD_EVENT_RULE,),
    },
    "child_attributes": {"group": (("hcp_id",), "attribute_type", fv.REQUIRED_CATEGORIES)},
}


@dataclass(frozen=True)
class FeedSpec:
    feed_type: str
    table: str
    inbound: str
    preprocess: str
    file_prefix: str
    sep: str
    columns: tuple[str, ...]
    rules: FeedRules

    @property
    def preprocess_path(self) -> str:
        return f"{self.preprocess.rstrip('/')}/{self.table}"


_LINKS = {
    "hcp_master": (
        Link("address", ("hcp_id",), ("hcp_id",)),
        Link("child_attributes", ("hcp_id",), ("hcp_id",)),
    ),
    "address": (Link("hcp_master", ("hcp_id",), ("hcp_id",)),),
    "child_attributes": (Link("hcp_master", ("hcp_id",), ("hcp_id",)),),
}

DEFAULT_RULES: dict[str, FeedRules] = {
    feed_type: FeedRules(
        keys=fv.KEYS[feed_type],
        required=fv.REQUIRED[feed_type],
        links=_LINKS.get(feed_type, ()),
        link_reason=(
            fv.REASON_MISSING_CHILD if feed_type == "hcp_master" else fv.REASON_MISSING_PARENT
        ),
        file_pattern=fv.FILE_PATTERNS.get(feed_type),
        parent=feed_type == "hcp_master",
    )
    for feed_type in fv.KEYS
}


def read_rules(spark: SparkSession, path: str) -> dict[str, FeedRules]:
    """Rules per feed type from a JSON file; a feed type it leaves out keeps its default.

    Each entry may set ``keys``, ``required``, ``aliases``, ``modified``, ``file_pattern``,
    ``link_reason``, ``parent`` and ``links`` (each with ``feed_type``, ``columns``,
    ``other_columns``), and of the feed contract ``types``, ``domains``, ``dates``,
    ``conditional`` and ``group``. ``contract`` names the ready rules to start from.
    """
    rules = dict(DEFAULT_RULES)
    entries = json.loads(spark.read.text(path, wholetext=True).first()[0])
    for feed_type, given in entries.items():
        values = dict(given)
        values = dict(CONTRACTS[values.pop("contract")]) | values if "contract" in values else values
        for name in ("keys", "required", "dates"):
            if name in values:
                values[name] = tuple(values[name])
        if "conditional" in values:
            values["conditional"] = tuple(tuple(rule) for rule in values["conditional"])
        if values.get("group"):
            columns, column, any_of = values["group"]
            values["group"] = (tuple(columns), column, tuple(any_of))
        if "links" in values:
            values["links"] = tuple(
                Link(link["feed_type"], tuple(link["columns"]), tuple(link["other_columns"]))
                for link in values["links"]
            )
        rules[feed_type] = replace(rules.get(feed_type, FeedRules()), **values)
    return rules


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Scan the control table: delimited text with a header, all columns text."""
    control = spark.read.options(header=True, quote='"').csv(path)
    return require_columns(control, fv.CONTROL_COLUMNS, "control table")


def named(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows whose ``column`` equals ``name``, ignoring case."""
    return df.where(F.lower(column) == name.lower())


def named_like(df: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose ``column`` contains ``part``, ignoring case."""
    escaped = part.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return df.where(F.col(column).ilike(f"%{escaped}%"))


def feed_type_of(table: str) -> str:
    name = table.lower().removeprefix("lm_")
    return {"events": "event", "participants": "participant"}.get(name, name)


def load_specs(
    control: DataFrame, rules: Mapping[str, FeedRules] = DEFAULT_RULES
) -> dict[str, FeedSpec]:
    """All feeds of a control table (one row per feed, so it is small) by feed type.

    An optional control column ``feed_type`` separates the kind of feed from its table name.
    """
    require_columns(control, fv.CONTROL_COLUMNS, "control table")
    specs: dict[str, FeedSpec] = {}
    for row in control.collect():
        values = row.asDict()
        table = values["target_table_name"]
        feed_type = (values.get("feed_type") or feed_type_of(table)).lower()
        if feed_type not in rules:
            raise ValueError(f"Unknown feed type: {feed_type}")
        if feed_type in specs:
            raise ValueError(f"More than one control row for feed type: {feed_type}")
        specs[feed_type] = FeedSpec(
            feed_type=feed_type,
            table=table,
            inbound=values["inbound_location"],
            preprocess=values["preprocess_location"],
            file_prefix=values["file_prefix"],
            sep=values["delimiter"],
            columns=tuple(c.strip() for c in values["expected_column_list"].split(",")),
            rules=rules[feed_type],
        )
    for name, spec in specs.items():
        lost = [link.feed_type for link in spec.rules.links if link.feed_type not in specs]
        if lost:
            raise ValueError(f"Feed {name} is linked to feeds without control row: {lost}")
    return specs
