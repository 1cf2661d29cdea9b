"""The portfolio summary as a stored view that changes are counted into, instead of a recomputation.

A changed customer takes its old row out of one band and puts its new row into another: the view keeps, per
band, the number of customers, the number of scores and their sum as a decimal. Sums of decimals are exact, so what was
put in comes out again to the last digit, in whatever order changes arrive. Each batch of changes is one published
version that notes the batch's number; a batch that comes again changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.published import Version, publish, version

#: Scores are kept to twelve digits; sums have room for 10**14 customers.
SCORE, SUM = "decimal(24,12)", "decimal(38,12)"
GROUP, VALUE, KEY = "risk_band", "risk_score", "customer_id"


def change_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Customers that came, went or differ, null-safe, in band or score: ``old`` and ``new`` hold (risk_band, risk_score), null where there is no row.

    For sources that send no change records; a change log has these columns already.
    """
    side = F.struct(GROUP, VALUE)
    before, after = old.select(KEY, side.alias("old")), new.select(KEY, side.alias("new"))
    both = before.join(after, KEY, "full_outer")
    return both.where(~F.col("old").eqNullSafe(F.col("new")))


def _counted(rows: DataFrame) -> DataFrame:
    """Per band how rows (risk_band, risk_score, n) change its counts and its sum; n is 1 or -1."""
    score = F.col(VALUE).cast(SCORE)
    return rows.groupBy(GROUP).agg(
        F.sum("n").cast("long").alias("customers"), F.sum(F.when(score.isNotNull(), F.col("n")).otherwise(0)).cast("long").alias("scores"),
        F.coalesce(F.sum(score * F.col("n")), F.lit(0)).cast(SUM).alias("total"),
    )


def deltas(changes: DataFrame) -> DataFrame:
    """What changes do to the bands: the old row of each counts -1, the new one +1."""
    sides = F.array(
        F.struct(F.col("old").isNotNull().alias("there"), F.col(f"old.{GROUP}").alias(GROUP), F.col(f"old.{VALUE}").alias(VALUE), F.lit(-1).alias("n")),
        F.struct(F.col("new").isNotNull().alias("there"), F.col(f"new.{GROUP}").alias(GROUP), F.col(f"new.{VALUE}").alias(VALUE), F.lit(1).alias("n")),
    )
    return _counted(changes.select(F.inline(sides)).where("there"))


@dataclass(frozen=True)
class PortfolioView:
    """A stored summary below ``path``."""

    path: str

    def build(self, customers: DataFrame, batch: int = 0) -> Version:
        """Compute the view from all rows, as of a batch number."""
        return publish(_counted(customers.select(GROUP, VALUE, F.lit(1).alias("n"))), self.path, note={"batch": batch})

    def apply(self, changes: DataFrame, batch: int) -> Version:
        """Count a batch of changes in; only the changes and the stored bands are read.

        Batches have rising numbers; one that is not newer than the view changes nothing. A band whose customers would fall
        below zero is an error, as changes were lost or counted twice, and the view stays as it was.
        """
        spark = changes.sparkSession
        held = version(spark, self.path)
        if held is None:
            raise ValueError("the view is not built")
        if batch <= held.note["batch"]:
            return held
        merged = held.read(spark).unionByName(deltas(changes)).groupBy(GROUP).agg(
            F.sum("customers").alias("customers"), F.sum("scores").alias("scores"), F.sum("total").cast(SUM).alias("total")
        )
        broken = (F.col("customers") < 0) | (F.col("scores") < 0) | (F.col("scores") > F.col("customers"))
        facts = {"broken": F.count_if(broken)}

        def accept(found: dict) -> None:
            if found["broken"]:
                raise ValueError(f"changes do not fit the view in {found['broken']} bands")

        return publish(merged.where(broken | (F.col("customers") != 0)), self.path, facts, accept, {"batch": batch}, after=held.number)

    def read(self, spark: SparkSession) -> DataFrame:
        """risk_band, customer_count, avg_risk_score."""
        held = version(spark, self.path)
        if held is None:
            raise ValueError("the view is not built")
        mean = F.col("total").cast("double") / F.col("scores")
        return held.read(spark).select(GROUP, F.col("customers").alias("customer_count"), F.when(F.col("scores") > 0, mean).alias("avg_risk_score"))

    def follow(self, changes: DataFrame, checkpoint: str) -> None:
        """Count a change stream in, a micro-batch each, until nothing is left.

        For a view built as of batch 0 that no other writer feeds: micro-batch n of the checkpoint is batch n + 1, so one that runs
        again after a failure changes nothing.
        """

        def count_in(rows: DataFrame, at: int) -> None:
            self.apply(rows, at + 1)

        changes.writeStream.foreachBatch(count_in).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
