r"""Chat formatting with Spark expressions only: turns become one string per conversation, and can be read back.

The template writes a block ``<|role:user|>`` ... ``<|end|>`` and a line break for each run of turns of one role, with
``<|turn|>`` between the turns of a run. Inside roles and texts ``\`` becomes ``\s`` and ``|`` becomes ``\p``, so
no text can hold a mark and each text comes back exactly.

Defined cases: null texts and roles are empty; turns with equal numbers are ordered by role, then text, and repeated rows
are turns of their own; a null turn number comes first; rows without a conversation number form one conversation; an
empty table gives no conversations.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalflow.llm.common import picked

ROLE, CLOSE, TURN, END = "<|role:", "|>", "<|turn|>", "<|end|>\n"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("|"), F.lit("\\p"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\s"), F.lit("\\"))


def format_chats(turns: DataFrame, trained: str = TRAINED) -> DataFrame:
    """conv_id, ``segments`` (text and whether it is trained on) and ``formatted``, which is the segments in a row.

    The turns of a conversation are collected and sorted; one conversation is one training text, so it is the natural
    bound of a group. Runs of one role are found from their first turns, in a single pass over the array.
    """
    df = picked(turns, conv_id="conv_id", turn="turn", role="role", text="text")
    df = df.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns")
    )
    changes = lambda t, i: (i == 0) | (t["role"] != F.get("turns", i - 1)["role"])
    df = df.withColumn(
        "starts",
        F.filter(F.transform("turns", lambda t, i: F.when(changes(t, i), i)), lambda i: i.isNotNull()),
    )
    # Merge each run into its role and the array of its texts.
    run = lambda s, k: F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - s)
    df = df.withColumn(
        "blocks",
        F.transform("starts", lambda s, k: F.struct(F.get("turns", s)["role"].alias("role"), F.transform(run(s, k), lambda t: t["text"]).alias("texts"))),
    )
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)

    def of_block(block: Column) -> Column:
        inside = F.transform(
            block["texts"],
            lambda text, i: F.array(
                piece(F.when(i == 0, F.lit("")).otherwise(F.lit(TURN)), no),
                piece(escaped(text), block["role"] == trained),
            ),
        )
        head = F.array(piece(F.concat(F.lit(ROLE), escaped(block["role"]), F.lit(CLOSE)), no))
        return F.concat(head, F.flatten(inside), F.array(piece(F.lit(END), no)))

    df = df.select("conv_id", F.filter(F.flatten(F.transform("blocks", of_block)), lambda s: s["text"] != "").alias("segments"))
    return df.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda b: b != "")

    def of_block(block: Column) -> Column:
        role = F.substring_index(F.substr(block, F.lit(len(ROLE) + 1)), CLOSE, 1)
        texts = F.split(F.substr(block, F.length(role) + F.lit(len(ROLE) + len(CLOSE) + 1)), r"<\|turn\|>", -1)
        return F.transform(texts, lambda t: F.struct(unescaped(role).alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, of_block))
