"""Building message tables: one row per message with ``payload`` as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REQUEST_PATH = "$.messages[-1].content"
RESPONSE_PATH = "$.choices[0].message.content"


def chat_request(text: Column, role: Column | str = "user", model: str = "chat-model",
                 system: str | None = None) -> Column:
    """Chat request body; the message of interest is the last one."""
    def message(who, what):
        return F.struct(who.alias("role"), what.alias("content"))

    role = F.lit(role) if isinstance(role, str) else role
    messages = [message(role, text)]
    if system is not None:
        messages.insert(0, message(F.lit("system"), F.lit(system)))
    return F.to_json(
        F.struct(F.lit(model).alias("model"), F.array(*messages).alias("messages"))
    )


def chat_response(text: Column) -> Column:
    """Chat response body."""
    message = F.struct(F.lit("assistant").alias("role"), text.alias("content"))
    return F.to_json(
        F.struct(F.array(F.struct(message.alias("message"))).alias("choices"))
    )


def conversation_messages(conversations: DataFrame, model: str = "chat-model",
                          system: str | None = None) -> DataFrame:
    """One message per turn: assistant turns are responses, others requests.

    A response shares its ``msg_id`` with the turn before it, which it answers.
    Each turn is built from its own row, so the table is never shuffled and no
    conversation, however long, has to fit into one task.
    """
    response = F.col("role") == "assistant"
    asked = F.when(response, F.col("turn") - 1).otherwise(F.col("turn"))
    return conversations.select(
        "conv_id",
        "turn",
        F.concat_ws(":", F.col("conv_id").cast("string"), asked.cast("string")).alias("msg_id"),
        F.when(response, "RESPONSE").otherwise("REQUEST").alias("direction"),
        F.when(response, chat_response(F.col("text")))
        .otherwise(chat_request(F.col("text"), F.col("role"), model, system))
        .alias("payload"),
    )


def text_messages(table: DataFrame, key: str, text: Column, direction: str = "REQUEST",
                  *keep: str) -> DataFrame:
    """One chat message per row of a text table."""
    body = chat_response(text) if direction == "RESPONSE" else chat_request(text)
    return table.select(
        F.col(key).alias("msg_id"), F.lit(direction).alias("direction"),
        body.alias("payload"), *keep,
    )
