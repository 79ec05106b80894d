"""Fixed tables the data model refers to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Chat models with their message length and token limits.
MODELS = [
    ("gpt-3.5-turbo", "GPT-3.5", 12000, 4000),
    ("gpt-35-turbo", "GPT-3.5", 12000, 4000),
    ("gpt-4", "GPT-4", 24000, 8000),
    ("gpt-4-32k", "GPT-4-32K", 96000, 32000),
]
# What a conversation without these settings gets.
DEFAULT_MODEL = "gpt-3.5-turbo"
DEFAULT_TEMPERATURE = 0.0
DEFAULT_PROMPT = ("You are ChatGPT, a large language model trained by OpenAI. "
                  "Follow the user's instructions carefully. Respond using markdown.")

# Clothing classes 0..9 of the image classifier.
CLASS_NAMES = ["T-shirt/top", "Trouser", "Pullover", "Dress", "Coat",
               "Sandal", "Shirt", "Sneaker", "Bag", "Ankle boot"]

# Reasons a reader can tick below a reply.
FEEDBACK_REASONS = ["This is harmful / unsafe", "This isn't true", "This isn't helpful"]


def values_frame(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small literal table Catalyst knows the size of, so joins to it broadcast by themselves."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def model_table(spark: SparkSession) -> DataFrame:
    return values_frame(spark, ["model_id", "model_name", "max_length", "token_limit"], MODELS)


def sql_values(rows: list[tuple]) -> str:
    """The same rows as the body of a SQL VALUES list."""
    quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(quote(v) for v in row) + ")" for row in rows)
