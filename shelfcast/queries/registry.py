"""Registration of queries next to their SQL checks."""

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import functions as F

from shelfcast.queries.shared_sql import SHARED
from shelfcast.session import ship_package
from shelfcast.sources.stored_tables import StoredTables

REGISTERED = {}


@dataclass
class Registered:
    build: Callable
    sql: str | None
    rounded: tuple
    digits: int

    def run(self, spark, folder):
        ship_package(spark)
        frame = self.build(StoredTables(spark, folder))
        return frame.withColumns({c: _rounded(c, self.digits) for c in self.rounded})

    def oracle(self):
        """The check with the shared tables in front and the same columns rounded."""
        cells = ", ".join(
            f"round(CAST({c} AS DOUBLE), {self.digits}) + 0.0 AS {c}" for c in self.rounded
        )
        chosen = f"* REPLACE ({cells})" if cells else "*"
        return f"{SHARED},\nanswer AS (\n{self.sql.strip()}\n)\nSELECT {chosen} FROM answer"


def _rounded(name, digits):
    return F.round(F.col(name).cast("double"), digits) + F.lit(0.0)


def query(name, sql=None, rounded="", digits=4):
    """Registers `fn(tables) -> DataFrame`; `rounded` names its fractional columns."""

    def add(fn):
        if name in REGISTERED:
            raise ValueError(f"query {name} registered twice")
        REGISTERED[name] = Registered(fn, sql, tuple(rounded.split()), digits)
        return fn

    return add
