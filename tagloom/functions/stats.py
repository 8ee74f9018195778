"""Statistics that survive groups without variance and can be added up.

``Moments`` keeps the sums of two whole-number columns x and y exactly, as
integers. Sums may then be built per question, shifted by the question's own
date, and added per tag pair, and the result is the same to the last digit
however the rows were split over tasks. Doubles would lose digits in the shift.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = "decimal(38,0)"
# rows is over all rows, y_n and y over those where y is known, n, x and xx over those where
# x is; the sums that begin with p are over the pairs, where both are.
SUMS = ("rows", "y_n", "y", "n", "x", "xx", "pn", "px", "pxx", "py", "pyy", "pxy")
INTEGERS = ("rows", "y_n", "y", "n", "pn", "py")


def corr_or_null(x: Column, y: Column) -> Column:
    """Correlation of a group, NULL where a side has no variance.

    The built-in ``corr`` divides by zero there, which is an error in ANSI mode.
    """
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)  # pairs only
    spread = F.stddev_samp(x) * F.stddev_samp(y)
    return F.try_divide(F.covar_samp(x, y), spread)


@dataclass(frozen=True)
class Moments:
    """Names of the sums of a group."""

    prefix: str = "m_"

    def __getitem__(self, name: str) -> Column:
        return F.col(self.prefix + name)

    def of_rows(self, x: Column, y: Column) -> list[Column]:
        """Aggregates over rows; x (bigint) and y (int) may be NULL."""
        x16, y64 = x.cast("decimal(16,0)"), y.cast("bigint")
        pair_x, pair_y = F.when(y.isNotNull(), x16), F.when(x.isNotNull(), y64)
        return self._named(
            rows=F.count(F.lit(1)),
            y_n=F.count(y),
            y=F.sum(y64),
            n=F.count(x),
            x=F.sum(x16),
            xx=F.sum(x16 * x16),
            pn=F.count(F.when(y.isNotNull(), x)),
            px=F.sum(pair_x),
            pxx=F.sum(pair_x * pair_x),
            py=F.sum(pair_y),
            pyy=F.sum((pair_y * pair_y).cast("decimal(19,0)")),
            pxy=F.sum(x16 * y.cast("decimal(10,0)")),
        )

    def of_sums(self) -> list[Column]:
        """Aggregates that add up the sums of smaller groups."""
        return self._named(**{name: F.sum(self[name]) for name in SUMS})

    @property
    def columns(self) -> list[Column]:
        return [self[name] for name in SUMS]

    def shifted(self, origin: Column) -> list[Column]:
        """The sums as if ``origin`` had been taken from every x: none is known
        where ``origin`` is NULL."""
        d = origin.cast("decimal(16,0)")
        n, pn = self["n"].cast("decimal(16,0)"), self["pn"].cast("decimal(16,0)")
        known = origin.isNotNull()
        return self._named(
            rows=self["rows"],
            y_n=self["y_n"],
            y=self["y"],
            n=F.when(known, self["n"]).otherwise(0),
            x=self["x"] - n * d,
            xx=self["xx"] - F.lit(2) * d * self["x"] + n * d * d,
            pn=F.when(known, self["pn"]).otherwise(0),
            px=self["px"] - pn * d,
            pxx=self["pxx"] - F.lit(2) * d * self["px"] + pn * d * d,
            py=F.when(known, self["py"]),
            pyy=F.when(known, self["pyy"]),
            pxy=self["pxy"] - d * self["py"],
        )

    def _named(self, **columns: Column) -> list[Column]:
        return [
            (c if name in INTEGERS else c.cast(EXACT)).alias(self.prefix + name)
            for name, c in columns.items()
        ]

    def statistics(self, sums: DataFrame, *keys: str) -> DataFrame:
        """Per row of sums: row_count, mean_x, mean_y, stddev_x (sample; NULL for a
        single row) and corr of the pairs (NULL where a side has no variance).

        The sums are taken about whole numbers next to the means, and are still
        exact; only the last step, whose correction is below n, is in doubles.
        """
        m = self.prefix
        exact = [f"cast({m}{c} as {EXACT}) as {c}" for c in ("x", "xx", "px", "pxx", "py", "pyy", "pxy")]
        counts = [f"nullif({m}{c}, 0) as {c}" for c in ("y_n", "n", "pn")]
        near = sums.selectExpr(*keys, f"{m}rows as row_count", f"{m}y as y", *counts, *exact).selectExpr(
            "*",
            f"cast(x div n as {EXACT}) as o",
            f"cast(px div pn as {EXACT}) as p",
            f"cast(py div pn as {EXACT}) as q",
        )
        about = near.selectExpr(
            *keys,
            "row_count",
            "n",
            "double(x) / n as mean_x",
            "double(y) / y_n as mean_y",
            "double(xx - 2 * o * x + n * o * o) - double(x - n * o) * double(x - n * o) / n as xx",
            "double(pxx - 2 * p * px + pn * p * p) - double(px - pn * p) * double(px - pn * p) / pn as pxx",
            "double(pyy - 2 * q * py + pn * q * q) - double(py - pn * q) * double(py - pn * q) / pn as pyy",
            "double(pxy - p * py - q * px + pn * p * q) - double(px - pn * p) * double(py - pn * q) / pn as pxy",
        )
        return about.selectExpr(
            *keys,
            "row_count",
            "mean_x",
            "mean_y",
            "sqrt(if(xx > 0, xx, xx * 0) / nullif(n - 1, 0)) as stddev_x",
            """case when pxx > 0 and pyy > 0
                 then greatest(-1d, least(1d, pxy / (sqrt(pxx) * sqrt(pyy)))) end as corr""",
        )
