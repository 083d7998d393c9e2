"""Fine-tuning data from articles or conversation arrays: one narrow plan, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.functions.chat import (
    ChatTemplate, insert_system, paper_conversation, render_chat, repair_turns, replace_system,
    response_spans,
)
from folioframe.operators.datasets import SEED, hash_split

POLICIES = {"replace": replace_system, "insert": insert_system}


def paper_records(articles: DataFrame) -> DataFrame:
    """``(pos, conversations)`` chat records of articles."""
    return articles.select("pos", paper_conversation("title", "content", "abstract").alias("conversations"))


def training_texts(
    records: DataFrame, key: str, template: ChatTemplate, system: str, policy: str = "insert",
    test_size: float = 0.2, seed: int = SEED, spans: bool = False,
) -> DataFrame:
    """Records with repaired turns, system policy, rendered ``text`` and ``split``; with
    ``spans`` also the character spans of the answers to train on."""
    shaped = records.withColumn("conversations", repair_turns("conversations"))
    shaped = shaped.withColumn("conversations", POLICIES[policy](F.col("conversations"), system))
    shaped = shaped.withColumn("text", render_chat("conversations", template))
    if spans:
        shaped = shaped.withColumn("spans", response_spans("conversations", template))
    return hash_split(shaped, key, test_size, seed)
