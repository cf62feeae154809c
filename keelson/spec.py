"""Column catalogs: what a raw table is expected to hold.

Every operator takes a ``TableSpec``, so the same jobs run on any table that
has one.  ``house_spec`` is the catalog of the house pricing data.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from pyspark.sql import types as T

TASKS = ("regression", "classification")
NUMBER_KINDS = frozenset({"numeric", "money", "boolean"})

SOURCE_COLUMN = "record_source"
MOMENT_COLUMN = "predicted_at"
ORIGINAL = "original"
FEEDBACK = "feedback"


def expected(name: str, kind: str, low: float | None = None, high: float | None = None,
             words: tuple[str, ...] = (), nullable: bool = True) -> T.StructField:
    """A text column and, as its metadata, what its values should be once read."""
    told = {"kind": kind, "low": low, "high": high, "words": list(words)}
    return T.StructField(name, T.StringType(), nullable, {k: v for k, v in told.items() if v not in (None, [])})


class Expectation:
    """What the metadata of a schema field says."""

    def __init__(self, field: T.StructField):
        self.name, self._told = field.name, field.metadata

    @property
    def kind(self) -> str:
        return self._told["kind"]

    @property
    def low(self) -> float | None:
        return self._told.get("low")

    @property
    def high(self) -> float | None:
        return self._told.get("high")

    @property
    def words(self) -> tuple[str, ...] | None:
        return tuple(self._told["words"]) if "words" in self._told else None

    @property
    def bounded(self) -> bool:
        return "low" in self._told or "high" in self._told


@dataclass(frozen=True)
class TableSpec:
    """A raw table's schema plus what each training task does with it.

    ``schema`` lists the columns as they are read, each with its expectation as
    field metadata, so the catalog travels wherever a Spark schema does.
    ``targets`` names the label per task and ``target_sources`` the raw column
    it is read from.  For classification the label is true when the source
    holds one of ``positive_values``.
    """

    schema: T.StructType
    id_column: str
    date_column: str | None = None
    targets: Mapping[str, str] = field(default_factory=dict)
    target_sources: Mapping[str, str] = field(default_factory=dict)
    positive_values: tuple[str, ...] = ()
    leakage: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    group_columns: tuple[str, ...] = ()
    model_names: Mapping[str, str] = field(default_factory=dict)

    def __contains__(self, name: str) -> bool:
        return name in self.schema.names

    def __getitem__(self, name: str) -> Expectation:
        return Expectation(self.schema[name])

    @property
    def columns(self) -> list[Expectation]:
        return [Expectation(f) for f in self.schema.fields]

    @property
    def names(self) -> list[str]:
        return list(self.schema.names)

    def to_json(self) -> str:
        own = {f.name: getattr(self, f.name) for f in fields(self)}
        return json.dumps(own | {"schema": self.schema.jsonValue()})

    @classmethod
    def from_json(cls, text: str) -> TableSpec:
        own = json.loads(text)
        schema = T.StructType.fromJson(own.pop("schema"))
        return cls(schema, **{k: tuple(v) if isinstance(v, list) else v for k, v in own.items()})

    def of_kind(self, kind: str) -> list[str]:
        return [c.name for c in self.columns if c.kind == kind]

    def check_task(self, task: str) -> None:
        if task not in self.targets:
            raise ValueError(f"unknown task {task!r}, expected one of {sorted(self.targets)}")

    def target(self, task: str) -> str:
        self.check_task(task)
        return self.targets[task]

    def excluded(self, task: str) -> list[str]:
        """Id, label and leakage columns, in catalog order."""
        self.check_task(task)
        out = {self.id_column, self.targets[task], *self.leakage.get(task, ())}
        return [n for n in self.names if n in out]

    def features(self, task: str) -> list[str]:
        out = set(self.excluded(task))
        return [n for n in self.names if n not in out]

    @property
    def date_parts(self) -> tuple[str, str] | None:
        if self.date_column is None:
            return None
        stem = self.date_column.removesuffix("_date")
        return f"{stem}_year", f"{stem}_month"

    def encoded_features(self, task: str) -> tuple[list[str], list[str]]:
        """(numeric, categorical) feature columns as they look after cleaning."""
        numeric, categorical = [], []
        for name in self.features(task):
            kind = self[name].kind
            if kind in NUMBER_KINDS:
                numeric.append(name)
            elif kind in ("categorical", "zipcode"):
                categorical.append(name)
        if self.date_column in self.features(task):
            numeric.extend(self.date_parts)
        return numeric, categorical

    def planning_columns(self, task: str, available: list[str]) -> list[str]:
        """The few columns needed to decide which set a row belongs to."""
        wanted = [
            self.id_column, self.date_column, SOURCE_COLUMN, MOMENT_COLUMN,
            self.target_sources[task], self.target(task),
        ]
        return [n for n in dict.fromkeys(wanted) if n in available]


def house_spec(newest_year: int) -> TableSpec:
    """The house pricing catalog.

    ``newest_year`` bounds ``year_built``; it is a parameter so that a rerun in
    a later year gives the same rows.
    """
    # Column names, kinds, bounds and allowed words of the data set.
    schema = T.StructType([
        expected("property_id", "id", nullable=False),
        expected("listing_date", "date"),
        expected("city", "categorical"),
        expected("state", "categorical"),
        expected("zipcode", "zipcode"),
        expected("property_type", "categorical", words=(
            "single family", "condo", "townhouse", "multi family", "land")),
        expected("lot_size_sqft", "numeric", 0, 1_000_000),
        expected("living_area_sqft", "numeric", 0, 50_000),
        expected("bedrooms", "numeric", 0, 20),
        expected("bathrooms", "numeric", 0, 15),
        expected("year_built", "numeric", 1800, newest_year),
        expected("stories", "numeric", 0, 5),
        expected("garage_spaces", "numeric", 0, 6),
        expected("has_pool", "boolean"),
        expected("hoa_fee_monthly", "numeric", 0, 5_000),
        expected("school_rating", "numeric", 1, 10),
        expected("crime_index", "numeric", 0, 100),
        expected("distance_to_city_center_km", "numeric", 0, 200),
        expected("condition", "categorical", words=("poor", "fair", "good", "excellent")),
        expected("days_on_market", "numeric", 0, 3_650),
        expected("list_price", "money", 0),
        expected("sale_price", "money", 0),
        expected("price_category", "categorical", words=("low", "medium", "high", "luxury")),
        expected("sold_within_30_days", "boolean"),
    ])
    return TableSpec(
        schema=schema,
        id_column="property_id",
        date_column="listing_date",
        targets={"regression": "sale_price", "classification": "needs_renovation"},
        target_sources={"regression": "sale_price", "classification": "condition"},
        positive_values=("poor", "fair"),
        leakage={
            "regression": ("list_price", "price_category"),
            "classification": ("condition", "sale_price", "days_on_market",
                               "sold_within_30_days", "price_category"),
        },
        group_columns=("city", "property_type"),
        model_names={
            "regression": "house_price_regressor",
            "classification": "house_needs_renovation_classifier",
        },
    )
