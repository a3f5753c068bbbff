"""Rate cards: small reference tables, read with their declared schema and measured once."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from haulrate.params import Limits
from haulrate.sources.schemas import UNREAD, schema_of


def conform(df: DataFrame, schema: T.StructType, optional: Collection[str] = ()) -> DataFrame:
    """Exactly the declared columns, cast; a NULL in a NOT NULL column fails the job.

    An absent column fails at once, as rules that read it would find nothing. Only ``id``, which
    does no more than break ties, and ``optional`` columns are filled with NULL.
    """
    given = {name.lower(): name for name in df.columns}
    fillable = {field.name for field in schema if field.nullable} & {"id", *optional}

    def column(field: T.StructField) -> str:
        kind, name = field.dataType.simpleString(), field.name
        if name.lower() not in given:
            if name not in fillable:
                raise ValueError(f"column {name!r} is required")
            return f"cast(NULL AS {kind}) AS `{name}`"
        value = f"cast(`{given[name.lower()]}` AS {kind})"
        if not field.nullable:
            value = f"coalesce({value}, raise_error('NULL in column {name}'))"
        return f"{value} AS `{name}`"

    return df.selectExpr(*[column(field) for field in schema.fields])


class Card:
    """A table to look values up in, measured on first use to decide how it may be joined."""

    def __init__(self, df: DataFrame, limits: Limits, rows: int | None = None):
        self.df = df
        self.limits = limits
        self._bound = rows
        self._prepared: dict[tuple, object] = {}

    def rows_if_at_most(self, most: int) -> list[Row] | None:
        """The rows themselves, or None if there are more."""
        rows = self.df.limit(most + 1).collect()
        return rows if len(rows) <= most else None

    @cached_property
    def literals(self) -> list[Row] | None:
        """The rows themselves if they are few enough to be written into the plan."""
        return self.rows_if_at_most(self.limits.literal_rows)

    @cached_property
    def rows(self) -> int:
        """The number of rows, or a bound known from the tables the card is made of."""
        if self._bound is not None:
            return self._bound
        return len(self.literals) if self.literals is not None else self.df.count()

    @property
    def small(self) -> bool:
        """Few enough rows to broadcast."""
        return self.rows <= self.limits.broadcast_rows

    @cached_property
    def single(self) -> Row | None:
        """The row of a table that holds at most one."""
        rows = self.rows_if_at_most(1)
        if rows is None:
            raise ValueError(f"expected at most one row in card {self.df.columns}")
        return rows[0] if rows else None

    def prepared(self, key: tuple, make: Callable[[], object]):
        """What lookups make of the card, made once however often it is looked up."""
        if key not in self._prepared:
            self._prepared[key] = make()
        return self._prepared[key]

    def derive(self, df: DataFrame, *others: Card) -> Card:
        """A card made from this one (and others); their rows together bound its size."""
        return Card(df, self.limits, self.rows + sum(card.rows for card in others))


class Cards:
    """All rate cards of a run by table name, read and measured when a rule first uses them."""

    def __init__(
        self,
        read: Callable[[str], DataFrame] | Mapping[str, DataFrame],
        limits: Limits | None = None,
    ):
        self.limits = limits or Limits()
        self._read = read.__getitem__ if isinstance(read, Mapping) else read
        self._cards: dict[str, Card] = {}

    @classmethod
    def load(cls, spark: SparkSession, directory: str, limits: Limits | None = None) -> Cards:
        """One Parquet table per card in a directory."""
        return cls(lambda name: spark.read.parquet(f"{directory}/{name}"), limits)

    def __getitem__(self, name: str) -> Card:
        if name not in self._cards:
            optional = UNREAD.get(name, "").split()
            rows = conform(self._read(name), schema_of(name), optional)
            self._cards[name] = Card(rows, self.limits)
        return self._cards[name]
