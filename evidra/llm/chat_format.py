r"""Chat formatting by grammar round trip, with DataFrame functions only.

A turn is written `### <role>[<level>]: <text></turn>` and a line feed. The grammar is deterministic:
`</turn>` with a line feed ends a turn wherever it stands, and the first `]: ` ends its head. Level 0
writes the text as it is and admits no control string; level 1 writes `\` as `\b`, `</turn>` as `\t`
and `###` as `\h`; level 2 writes base64. Each turn is parsed back at level 0, then 1, and takes the
lowest level whose parse equals its source.

Defined results: a null text or role is an empty one; turns go by (turn, role, text), null turns
first; repeated rows are turns of their own; rows of a null conversation form one conversation; an
empty table gives an empty one; other columns are left out.

The digest of a conversation is one sequential hash, so its formatted text meets in one task. Escapes
and the search for the level run before that, row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>\n"
#: Fixed values of the template: control strings and their codes, in the order of writing.
CODES = (("\\", "\\b"), ("</turn>", "\\t"), ("###", "\\h"))
#: What a role is coded with besides.
ROLE_CODES = (*CODES, ("[", "\\l"), ("]", "\\r"))
#: The role whose texts are trained on.
TRAINED = "assistant"


def _coded(text: Column, codes: tuple) -> Column:
    for a, b in codes:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def _plain(text: Column, codes: tuple) -> Column:
    for a, b in reversed(codes):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


def escape(text: Column, level: int) -> Column:
    return (text, _coded(text, CODES), F.base64(F.encode(text, "UTF-8")))[level]


def unescape(text: Column, level: Column) -> Column:
    return F.when(level == "0", text).when(level == "1", _plain(text, CODES)).otherwise(F.decode(F.unbase64(F.when(level == "2", text)), "UTF-8"))


def head(role: Column, level: int) -> Column:
    return F.concat(F.lit("### "), _coded(role, ROLE_CODES), F.lit(f"[{level}]: "))


def parse(turn: Column) -> Column:
    """struct(role, level, text) of one turn without its end mark; a null text if the grammar forbids it."""
    top = F.substring_index(turn, "]: ", 1)
    level = F.substring_index(top, "[", -1)
    body = F.substring(turn, F.length(top) + 4, F.length(turn))
    free = ~(body.contains("</turn>") | body.contains("###") | ((level == "0") & body.contains("\\")))
    return F.struct(_plain(F.substring(top, F.lit(5), F.length(top) - 5 - F.length(level)), ROLE_CODES).alias("role"), level.alias("level"), F.when(free, unescape(body, level)).alias("text"))


def parse_all(formatted: Column) -> Column:
    """The turns of a formatted conversation, by the grammar alone."""
    return F.transform(turns(formatted), parse)


def turns(formatted: Column) -> Column:
    return F.filter(F.split(formatted, END), lambda t: t != "")


def format_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per conversation: conv_id, formatted, mask.

    mask has a struct per turn: start (place of its text in formatted, code points), local (the same
    within the turn), length (of the text as written), level, trained.
    """
    src = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    role, text = F.col("role"), F.col("text")

    def reads(level: int) -> Column:
        got = parse(F.concat(head(role, level), escape(text, level)))
        return (got["role"] == role) & got["text"].eqNullSafe(text)

    level = F.when(reads(0), 0).when(reads(1), 1).otherwise(2)
    by = lambda f: F.when(F.col("level") == 0, f(0)).when(F.col("level") == 1, f(1)).otherwise(f(2))
    done = src.withColumn("level", level).withColumn("head", by(lambda k: head(role, k))).withColumn("body", by(lambda k: escape(text, k)))
    w = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    size = F.length("head") + F.length("body") + len(END)
    done = done.select("conv_id", F.row_number().over(w).alias("n"), F.concat("head", "body", F.lit(END)).alias("piece"),
                       F.struct((F.sum(size).over(w) - F.length("body") - len(END)).alias("start"), F.length("head").alias("local"), F.length("body").alias("length"), F.col("level").cast("string").alias("level"), (role == TRAINED).alias("trained")).alias("mask"))
    whole = done.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("n", "piece", "mask"))).alias("t"))
    return whole.select("conv_id", F.array_join("t.piece", "").alias("formatted"), F.col("t.mask").alias("mask"))


def loss_text(formatted: Column, mask: Column) -> Column:
    """What lies under the loss mask, read from the formatted text and unescaped."""
    under = F.zip_with(turns(formatted), mask, lambda t, m: F.when(m["trained"], unescape(F.substring(t, m["local"] + 1, m["length"]), m["level"])))
    return F.array_join(under, "")
