"""Chat formatting with Spark expressions only.

A conversation becomes one string of marked turns. `<|` inside a role or a text is written `<||`, so no text can
hold a marker, and reading back is exact. Adjacent turns of one role share a block; a separator keeps their texts
apart, so that the single turns can still be read back.

Defined results: a null text or role is empty; rows of one conversation are ordered by turn (null first), then role,
then text; repeated rows stay; conversations with a null id form one conversation; an empty table gives an empty
table; other columns of the input are ignored.

A conversation is one output row, so its rows meet in one task by nature; every step is linear in the turns: a turn looks at its
neighbours by place in the one sorted array, runs of one role are slices of it, and strings are joined once. (Folding with
`aggregate` would copy what has been gathered so far at each turn, be it a string or an array.)
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<|n|>"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|n|>"), F.lit("\n")))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """turns(conv_id, turn, role, text) -> conv_id, formatted, segments array<struct<piece, loss>>.

    The pieces of `segments` in order are `formatted`; `loss` is true on the texts of loss_role alone.
    """
    turn = F.struct(
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    all_turns = F.col("turns")
    # a run begins where the turn before has another role; get() takes one turn, whereas turns.role would build an array for each
    starts = F.filter(F.sequence(F.lit(0), F.size(all_turns) - 1), lambda i: ~F.get(all_turns, i)["role"].eqNullSafe(F.get(all_turns, i - 1)["role"]))
    begun = sorted_turns.withColumn("starts", starts)
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size(all_turns)))
    bounds = begun.select("conv_id", "turns", F.zip_with("starts", ends, lambda a, e: F.struct(a.alias("start"), (e - a).alias("n"))).alias("runs"))
    plain = lambda piece: F.struct(piece.alias("piece"), F.lit(False).alias("loss"))

    def block(run: Column) -> Column:
        """A run of one role: its opening, its texts with separators between them, its end."""
        texts = F.slice(all_turns, run["start"] + 1, run["n"])
        said = F.transform(texts, lambda t, i: F.array(
            plain(F.when(i == 0, F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))).otherwise(F.lit(SEP))),
            F.struct(escape(t["text"]).alias("piece"), (t["role"] == loss_role).alias("loss")),
        ))
        return F.concat(F.flatten(said), F.array(plain(F.lit(END + "\n"))))

    done = bounds.select("conv_id", F.flatten(F.transform("runs", block)).alias("segments"))
    return done.select("conv_id", F.array_join("segments.piece", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string: array<struct<role, text>>."""
    blocks = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda b: b != "")

    def turns_of(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substring_index(F.substr(block, F.length(role) + 2), END, 1)
        return F.transform(
            F.split(body, r"<\|im_sep\|>"),
            lambda t: F.struct(_unescape_role(role).alias("role"), unescape(t).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["piece"])), "")
