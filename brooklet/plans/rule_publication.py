"""Rule publication: audience, history baselines and metadata of new rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.functions.predicates import EventColumns
from brooklet.operators.audience import select_audience
from brooklet.operators.rules import RULE_KEY, Rule, baselines

MODEL_SCHEMA = "rule_model_id STRING, rule_model_name STRING, rule_model_status INT"


class RuleStore:
    """Rule metadata as Parquet tables: models, rules, audience bitmaps and baselines."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add_model(self, model_id: str, name: str, status: int) -> None:
        row = self.spark.createDataFrame([(model_id, name, status)], MODEL_SCHEMA)
        row.write.mode("append").parquet(f"{self.path}/models")

    def model(self, model_id: str) -> DataFrame:
        """The model, if it is switched on."""
        return self.spark.read.parquet(f"{self.path}/models").where(
            (F.col("rule_model_id") == model_id) & (F.col("rule_model_status") == 1))

    def add_rules(self, rules: DataFrame, members: DataFrame) -> None:
        """Append rules, and their audiences ``(rule_id, guid)`` as one bitmap per id bucket."""
        rules.write.mode("append").parquet(f"{self.path}/rules")
        bitmaps = members.groupBy("rule_id", F.bitmap_bucket_number(F.col("guid")).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(F.col("guid"))).alias("bits"))
        bitmaps.write.mode("append").parquet(f"{self.path}/audiences")

    def rules_of(self, model_id: str) -> DataFrame:
        """Rules in force of a model in force."""
        rules = self.spark.read.parquet(f"{self.path}/rules").where(F.col("rule_status") == 1)
        return rules.join(self.model(model_id), "rule_model_id", "left_semi")

    def audience_sizes(self) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.path}/audiences")
        return stored.groupBy("rule_id").agg(F.sum(F.bitmap_count("bits")).alias("audience"))

    def add_baselines(self, start: DataFrame) -> None:
        start.write.mode("append").parquet(f"{self.path}/baselines")

    def baselines(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/baselines")


def audience_of(rules: list[Rule], profiles: DataFrame) -> DataFrame:
    """``(rule_id, guid)`` of all rules; without profile conditions everyone is meant."""
    parts = [
        select_audience(profiles, list(rule.profile)).select(F.lit(rule.rule_id).alias("rule_id"), "guid")
        for rule in rules
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def publish(
    store: RuleStore, definitions: list[str], profiles: DataFrame, history: DataFrame,
    columns: EventColumns, order: list[str], until: Column,
) -> list[Rule]:
    """Publish rules given as JSON. Live matching starts at ``until``, where history ends."""
    rules = [Rule.parse(text) for text in definitions]
    members = audience_of(rules, profiles)
    start = baselines(history.where(F.col(columns.time) < until), rules, members, columns, order)
    store.add_baselines(start.select(*RULE_KEY, "base_counts", "base_step", "base_sequences"))
    rows = store.spark.createDataFrame(
        [(r.rule_id, r.model_id, text, 1) for r, text in zip(rules, definitions)],
        "rule_id STRING, rule_model_id STRING, rule_define_json STRING, rule_status INT")
    store.add_rules(rows, members)
    return rules
