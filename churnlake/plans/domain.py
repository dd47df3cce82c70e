"""The churn domain built from the driver tables: raw, cleaned, labels and
the feature matrix, all lazy DataFrames over the same scans."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from churnlake.operators import clean, features, labels
from churnlake.params import Params
from churnlake.sources import adapters


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = Params()):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params

    # raw ---------------------------------------------------------------
    @cached_property
    def raw_users(self) -> DataFrame:
        return adapters.raw_users(self.spark, self.sf_dir)

    @cached_property
    def raw_orders(self) -> DataFrame:
        return adapters.raw_orders(self.spark, self.sf_dir)

    @cached_property
    def raw_subscriptions(self) -> DataFrame:
        return adapters.raw_subscriptions(self.spark, self.sf_dir)

    @cached_property
    def raw_engagement(self) -> DataFrame:
        return adapters.raw_engagement(self.spark, self.sf_dir)

    # cleaned -------------------------------------------------------------
    @cached_property
    def users(self) -> DataFrame:
        return clean.clean_users(self.raw_users, self.params)

    @cached_property
    def orders(self) -> DataFrame:
        return clean.clean_orders(self.raw_orders, clean.min_signup(self.users), self.params.snapshot, self.params)

    @cached_property
    def subscriptions(self) -> DataFrame:
        return clean.clean_subscriptions(self.raw_subscriptions, self.params)

    @cached_property
    def engagement(self) -> DataFrame:
        return clean.clean_engagement(self.raw_engagement, self.params)

    @cached_property
    def labels(self) -> DataFrame:
        return clean.clean_labels(labels.label_churn(self.subscriptions, self.params))

    # features ------------------------------------------------------------
    @cached_property
    def joined_matrix(self) -> DataFrame:
        return features.joined_matrix(self.users, self.orders, self.subscriptions, self.engagement,
                                      self.labels, self.params)

    @cached_property
    def matrix(self) -> DataFrame:
        return features.impute_defaults(self.joined_matrix)
