"""Chat formatting from an event log, in DataFrame functions only.

The log of a conversation holds one event per row: `start` opens a message with its role, `delta`
appends text, `edit` replaces the text so far, `regenerate` discards the text of its message and
everything that later messages had been given up to then. Events are grouped by message, folded in
the order of their sequence numbers, and the messages are rendered in order.

Template: `<|im_start|>role\\ntext<|im_end|>\\n` for each turn. Inside roles and texts a backslash is
doubled and `<|` is written `<\\|`, so that no text can hold a control string; a line break in a
role is written `<\\-`.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Order of events with one sequence number.
KINDS = ["start", "regenerate", "edit", "delta"]


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\-"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\-"), F.lit("\n")))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of a log (conv_id, seq, message, kind, role, text).

    Null texts count as empty, null sequence numbers come first; equal ones are ordered by kind
    (start, regenerate, edit, delta), then text. The role of a message is that of its last event
    that names one; without any it is empty. A message whose events all came before a regeneration
    of an earlier message is gone. Rows with a null conv_id form a conversation of their own;
    unknown kinds raise. Other columns are ignored.
    """
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    rank = F.when(rank > 0, rank).otherwise(F.raise_error(F.concat(F.lit("unknown event kind: "), F.coalesce("kind", F.lit("null")))))
    event = F.struct(
        F.coalesce(F.col("seq").cast("long"), F.lit(-(2**63))).alias("seq"), rank.cast("int").alias("rank"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("role").alias("role"))
    messages = events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list(event)).alias("events"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq").cast("long"))).alias("regenerated"))
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    live = messages.withColumn("cut", F.max("regenerated").over(earlier)).withColumn(
        "events", F.when(F.col("cut").isNull(), F.col("events")).otherwise(
            F.filter("events", lambda e: e["seq"] > F.col("cut"))))
    # Text begins anew at the last edit or regeneration.
    resets = F.transform(
        F.filter("events", lambda e: e["rank"].isin(2, 3)), lambda e: F.struct(e["seq"], e["rank"], e["text"]))
    last = F.try_element_at(resets, F.lit(-1))
    after = F.filter("events", lambda e: F.col("reset").isNull() | (
        F.struct(e["seq"], e["rank"], e["text"]) >= F.col("reset")))
    texts = F.transform("kept", lambda e: F.when(e["rank"] == 2, "").otherwise(e["text"]))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return (
        live.filter(F.size("events") > 0).withColumn("reset", last).withColumn("kept", after)
        .select("conv_id", "message", F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
                F.array_join(texts, "").alias("text")))


def render(messages: DataFrame, train_on: str = "assistant") -> DataFrame:
    """conv_id, formatted, mask: one formatted text per conversation.

    The mask has one entry (skip, loss, rest) per turn, in order: code points of `formatted` outside
    the loss, under it and outside it again. The texts of the role `train_on` are under the loss.
    A conversation is one text, and so one row, whatever its length.
    """
    role, text = escape_role(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    under = F.when(F.col("role") == train_on, F.char_length(text)).otherwise(0)
    turn = messages.select(
        "conv_id", F.struct(
            F.col("message"), F.concat(head, text, F.lit(CLOSE)).alias("turn"),
            F.char_length(head).alias("skip"), under.alias("loss"),
            (F.char_length(text) - under + len(CLOSE)).alias("rest")).alias("turn"))
    rows = turn.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return rows.select(
        "conv_id", F.array_join(F.col("turns.turn"), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["skip"], t["loss"], t["rest"])).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss_text, formatted_chars, from rendered rows alone."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    parts = formatted.withColumn("pieces", pieces)
    turns = F.expr(f"transform(pieces, p -> substring(p, {len(OPEN) + 1}))")
    split = F.transform(turns, lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.char_length(p))).alias("text")))
    loss = F.expr("transform(pieces, (p, i) -> substring(p, mask[i].skip + 1, mask[i].loss))")
    return parts.select(
        "conv_id", split.alias("turns"), F.array_join(F.transform(loss, unescape), "").alias("loss_text"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


def format_conversations(events: DataFrame) -> DataFrame:
    """conv_id, formatted, mask of every conversation of an event log."""
    return render(fold_events(events))


def turn_events(rows: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text): each is opened and streamed in
    two deltas. Rows with one turn number stay separate, ordered by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    event = lambda k, kind, role, part: F.struct(
        (3 * F.col("message") + k).alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), part.alias("text"))
    nothing = F.lit(None).cast("string")
    return (
        rows.select("conv_id", "turn", "role", "text").withColumn("message", F.row_number().over(order).cast("long"))
        .select("conv_id", "message", F.explode(F.array(
            event(0, "start", F.coalesce("role", F.lit("")), F.lit("")),
            event(1, "delta", nothing, F.substring(text, F.lit(1), half)),
            event(2, "delta", nothing, F.substring(text, half + 1, F.char_length(text))))).alias("e"))
        .select("conv_id", "message", "e.*"))


def conversation_digests(rows: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations give when they are read back."""
    back = read_back(format_conversations(turn_events(rows)))
    turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
