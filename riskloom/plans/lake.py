"""The zones over one set of input tables, each table a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.plans import features, gold, silver
from riskloom.sources.bronze import AS_OF, bronze, given_table


class Lake:
    """Bronze to Gold as functions of the input folder. Nothing is computed until a table is used."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    def given(self, name: str) -> DataFrame:
        return given_table(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        return bronze(self.spark, self.sf_dir, name)

    @property
    def transactions(self) -> DataFrame:
        return silver.cleanse_transactions(self.raw("raw_transactions"))

    @property
    def members(self) -> DataFrame:
        return silver.cleanse_members(self.raw("raw_members"))

    @property
    def events(self) -> DataFrame:
        return silver.dedup_events(self.raw("streaming_events"))

    @property
    def alerts(self) -> DataFrame:
        """Alerts without the member columns, for readers that do not use them."""
        return silver.cleanse_alerts(self.raw("raw_alerts"))

    @property
    def enriched_alerts(self) -> DataFrame:
        return silver.enrich_alerts(self.raw("raw_alerts"), self.members)

    @property
    def daily(self) -> DataFrame:
        return gold.daily_member_summary(self.transactions)

    @property
    def signals(self) -> DataFrame:
        return gold.fraud_signals(self.alerts, self.events)

    def activity(self, mode: str = "literal") -> DataFrame:
        return gold.member_activity(self.members, self.transactions, self.alerts, self.as_of, mode=mode)

    def institutions(self, mode: str = "literal") -> DataFrame:
        return gold.institution_summary(self.raw("raw_institutions"), self.transactions, self.alerts, self.as_of,
                                        mode=mode)

    @property
    def online(self) -> DataFrame:
        return features.online_features(self.events, self.as_of)

    @property
    def offline(self) -> DataFrame:
        return features.offline_features(self.members, self.activity(), self.as_of)
