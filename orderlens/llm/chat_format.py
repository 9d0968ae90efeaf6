"""Chat formatting by prefix-target expansion.

A conversation is formatted once.  Every assistant turn becomes an example row of its
own: its context is the formatted text of all preceding turns, its target the
turn's own formatted text, and only the reply in the target is trainable.  Stored examples keep the
context by reference, as its length and a running digest of its turns, so they grow with the
conversation and not with its square; ``write_out`` expands them, each to its context's text and
its target, row by row and without a shuffle of the expanded text.

Template of a turn: ``<turn>role``, a line feed, the text, ``</turn>`` and a line
feed.  Backslash and ``<`` inside texts and roles are replaced by two-character
escapes (and line feeds inside roles), so no text can contain a control string,
and reading back is plain replacement.

Defined cases: null text or role is empty; turns of equal number are ordered by
role and text; repeated rows are turns of their own; a null conversation id is
one conversation; a conversation without an assistant turn has no example; an
empty table gives an empty result.  Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, CLOSE = "<turn>", "</turn>\n"
#: Escapes in the order of writing; reading back applies them in reverse.
TEXT_ESCAPES = (("\\", "\\b"), ("<", "\\l"))
ROLE_ESCAPES = (*TEXT_ESCAPES, ("\n", "\\n"))
TRAINED_ROLE = "assistant"


def escape(text: Column, escapes=TEXT_ESCAPES) -> Column:
    for plain, coded in escapes:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, escapes=TEXT_ESCAPES) -> Column:
    for plain, coded in reversed(escapes):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def rendered(turns: DataFrame) -> DataFrame:
    """(conv_id, n, role, piece, head): every turn's formatted text, with its number from 1 and where its text begins."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role, ROLE_ESCAPES), F.lit("\n"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).select(
        "conv_id", F.row_number().over(order).alias("n"), "role", F.length(head).alias("head"),
        F.concat(head, escape(F.col("text")), F.lit(CLOSE)).alias("piece"))


def with_context(pieces: DataFrame) -> DataFrame:
    """``pieces`` with context_length and context_digest, of all turns before each.  The digest is the bitwise
    sum of two hashes of (number, turn): it depends on every turn and its place, and one pass computes all."""
    before = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    length = F.coalesce(F.sum(F.length("piece").cast("bigint")).over(before), F.lit(0))
    digest = [F.coalesce(F.bit_xor(F.xxhash64(F.lit(salt), F.col("n"), F.col("piece"))).over(before), F.lit(0))
              for salt in (1, 2)]
    return pieces.select("*", length.alias("context_length"),
                         F.concat(F.hex(digest[0]), F.lit("-"), F.hex(digest[1])).alias("context_digest"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted) from rows (conv_id, turn, role, text)."""
    return rendered(turns).groupBy("conv_id").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("n", "piece"))), lambda x: x["piece"]), "").alias("formatted"))


def examples(turns: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, n (number of its turn), context_length, context_digest, target (formatted),
    and the span of the target that is trained: loss_start, loss_end (characters from 0, end exclusive)."""
    return with_context(rendered(turns)).where(F.col("role") == TRAINED_ROLE).select(
        "conv_id", "n", "context_length", "context_digest", F.col("piece").alias("target"),
        F.col("head").alias("loss_start"), (F.length("piece") - len(CLOSE)).alias("loss_end"))


def write_out(formatted: DataFrame, example_rows: DataFrame, keep=()) -> DataFrame:
    """The examples with the text of their contexts, as a trainer reads them: grows with the square
    of a conversation, as that text does.  ``keep``: further columns of either side."""
    return example_rows.join(formatted.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "n", F.substring("formatted", F.lit(1), F.col("context_length").cast("int")).alias("context"),
        "target", "loss_start", "loss_end", *keep)


def trained_examples(formatted: DataFrame, example_rows: DataFrame) -> DataFrame:
    """(conv_id, n, trained): the unescaped loss text of every example, read from the expanded example (the text of its
    context, then its target) at the loss span.  An example whose context is not the turns that the formatted
    conversation has before its own, or that the conversation does not hold as it stands, is no example."""
    read = formatted.select("conv_id", F.posexplode(pieces_of(F.col("formatted"))).alias("at", "piece"))
    held = with_context(read.select(F.col("conv_id").alias("of"), (F.col("at") + 1).alias("n"), "piece")
                        .withColumnRenamed("of", "conv_id")).select(
        F.col("conv_id").alias("of"), F.col("n").alias("at"), F.col("context_length").alias("length"),
        F.col("context_digest").alias("digest"))
    checked = example_rows.join(held, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("n") == F.col("at"))).where(
        (F.col("context_length") == F.col("length")) & (F.col("context_digest") == F.col("digest"))).drop("of", "at")
    example = F.concat("context", "target")
    loss = F.substr(example, F.length("context") + F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    return write_out(formatted, checked, keep=["formatted"]).where(F.startswith(F.col("formatted"), example)).select(
        "conv_id", "n", unescape(loss).alias("trained"))


def pieces_of(formatted: Column) -> Column:
    """Array of the formatted turns."""
    body = F.split(formatted, OPEN, -1)
    return F.transform(F.slice(body, 2, F.size(body)), lambda x: F.concat(F.lit(OPEN), x))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    body = F.split(formatted, OPEN, -1)
    return F.transform(F.slice(body, 2, F.size(body)), lambda x: F.struct(
        unescape(F.substring_index(x, "\n", 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(x, F.instr(x, "\n") + 1,
                          F.length(x) - F.instr(x, "\n") - len(CLOSE))).alias("text")))
