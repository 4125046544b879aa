"""Day-partitioned event log: what happened to orders on a day, so that the run of a day reads that day.

Delivered, refunded and paid orders and receipts are appended under the day they happened on, with the columns of the
order that scorecards need. A refund that comes late stands in the partition of its own day, and no earlier one is read
or written again. Appending a day again replaces it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gearledger.functions import predicates as P
from gearledger.functions.calendar import DateLike, between_days
from gearledger.operators import scorecard
from gearledger.sources.versions import publish_parts, read_parts

DAY = "event_day"
#: What a scorecard needs of an order.
ORDER_COLUMNS = [
    "id", "province", "city", "is_picc", "is_fbj", "is_direct", "vehicle_type", "order_amount", "purchase_amount",
    "oem_amount", "refund_amount", "refund_purchase_amount", "refund_oem_amount"]
RECEIPT_COLUMNS = [
    "iorder_id", "province", "city", "is_picc", "is_fbj", "is_direct", "vehicle_type", "purchase_amount", "receipts",
    "amount"]


def days_between(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]


class EventLog:
    """The two tables of the log below one folder, both partitioned by ``event_day``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.orders_folder, self.receipts_folder = (f"{folder.rstrip('/')}/{n}" for n in ("order_events", "receipts"))

    def append(self, orders: DataFrame, track: DataFrame, start: dt.date, end: dt.date,
               cutoff: DateLike = P.BROKER_TERM_START) -> None:
        """Write the events of the days from start to end; days that are there already are replaced, also by nothing.

        ``orders`` and ``track`` need to hold only the rows that have an event on those days.
        """
        bases = {**scorecard.DELIVERED, **scorecard.PAID}
        events = scorecard.order_events(orders, bases, start, end)
        received = scorecard.received_orders(track, orders, start, end, cutoff)
        days = [{DAY: d} for d in days_between(start, end)]
        day = F.col("stat_date").alias(DAY)
        publish_parts(events.select("basis", *ORDER_COLUMNS, day), self.orders_folder, [DAY], days)
        publish_parts(received.select(*RECEIPT_COLUMNS, day), self.receipts_folder, [DAY], days)

    def _rows(self, folder: str, start: DateLike | None, end: DateLike | None) -> DataFrame:
        return read_parts(self.spark, folder).where(between_days(F.col(DAY), start, end)).withColumnRenamed(
            DAY, "stat_date")

    def order_events(self, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
        return self._rows(self.orders_folder, start, end)

    def receipts(self, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
        return self._rows(self.receipts_folder, start, end)

    def daily_scorecard(self, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
        """As ``scorecard.daily_scorecard``, reading the partitions of the wanted days only."""
        return scorecard.scorecard_of_events(self.order_events(start, end), self.receipts(start, end))

    def vehicle_mix(self, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
        """As ``scorecard.vehicle_part_mix_net``, reading the partitions of the wanted days only."""
        dated = self.order_events(start, end).where(F.col("basis").isin(*scorecard.DELIVERED))
        return scorecard.vehicle_mix_of_events(dated)
