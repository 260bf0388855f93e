"""Chat formatting from event logs, in DataFrame functions only.

A log has one row per event: conv_id, message (orders the messages of a conversation), seq (orders the events of a message),
kind, role and text. Folding a message's events by seq: ``message`` starts a turn, ``delta`` appends streamed text,
``edit`` replaces the text, ``regenerate`` throws away what an answer had so far (later deltas build the new one), and
``delete`` takes the turn away until a later edit brings text back. Two ``message`` events under one number are two
turns. Events before any ``message`` start a turn themselves. Unknown kinds are ignored. A null text is empty, a null role
is empty; null numbers order first; ties in seq are settled by kind, role and text.

Rendering: ``### role: text</turn>`` and a line feed per turn. Inside roles and texts control strings are escaped,
reversibly: a backslash becomes ``\\s``, ``###`` becomes ``\\h`` and ``</turn>`` becomes ``\\e``; in roles a colon becomes
``\\c``. So an unescaped mark is always the template's own, and the rendered text splits at the marks.

The text of a conversation is one cell, by contract; everything before that, the folding of events, is spread over
messages, so that one hot conversation is folded by many tasks.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

START, COLON, END = "### ", ": ", "</turn>\n"
ESCAPES = (("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\e"))  # in this order; undone in the opposite order
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
KINDS = ("message", "delta", "edit", "regenerate", "delete")
LOSS_ROLES = ("assistant",)


def escaped(text: Column, escapes=ESCAPES) -> Column:
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), escapes, text)


def unescaped(text: Column, escapes=ESCAPES) -> Column:
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[1]), F.lit(pair[0])), reversed(escapes), text)


def events(conversations: DataFrame) -> DataFrame:
    """The log of finished conversations (conv_id, turn, role, text): one ``message`` event per row."""
    return conversations.select("conv_id", F.col("turn").alias("message"), F.col("turn").alias("seq"), F.lit("message").alias("kind"), "role", "text")


def streamed(conversations: DataFrame, delta: int = 400) -> DataFrame:
    """A log that ends in the same turns as ``events`` of these rows, as a chat service would have written it.

    A loss role's turn starts empty; its text arrives as a first draft of one delta, which a regeneration throws away, and
    then in deltas of ``delta`` characters. Any other turn is sent with a slip of its first character and put right by an edit.
    Rows that share a turn stand for turns of their own, so each takes a message number, in the order of role and text.
    """
    nulls_first = [F.col(c).asc_nulls_first() for c in ("role", "text")]
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy(*nulls_first))
    # Numbers order as turns do, a missing turn first.
    numbered = rows.withColumn("message", F.struct(F.col("turn"), nth.alias("nth")))
    said, pieces = F.col("text"), F.ceil(F.length("text") / delta).cast("int")

    def event(seq: Column, kind: str, text: Column) -> Column:
        return F.struct(seq.cast("bigint").alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    def nothing(kind: str, at: int) -> Column:
        return event(F.lit(at), kind, F.lit(""))

    parts = F.when(pieces > 0, F.sequence(F.lit(0), pieces - 1)).otherwise(F.array().cast("array<int>"))
    deltas = F.transform(parts, lambda i: event(i + 3, "delta", F.substring(said, i * delta + 1, F.lit(delta))))
    answer = F.concat(F.array(nothing("message", 0), event(F.lit(1), "delta", F.reverse(F.substring(said, 1, delta))), nothing("regenerate", 2)), deltas)
    sent = F.array(event(F.lit(0), "message", F.substring(said, F.lit(2), F.length(said))), event(F.lit(1), "edit", said))
    log = numbered.select("conv_id", "message", "role", F.explode(F.when(F.col("role").isin(*LOSS_ROLES), answer).otherwise(sent)).alias("event"))
    return log.select("conv_id", "message", "event.seq", "event.kind", "role", "event.text")


def folded(log: DataFrame) -> DataFrame:
    """(conv_id, message, version, role, text): the final turns."""
    rows = log.where(F.col("kind").isin(*KINDS)).select(
        "conv_id", "message", "seq", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = [F.col("seq"), F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.col("role"), F.col("text")]
    of_message = Window.partitionBy("conv_id", "message").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    versions = rows.withColumn("version", F.greatest(F.lit(1), F.count_if(F.col("kind") == "message").over(of_message)))
    of_version = Window.partitionBy("conv_id", "message", "version").orderBy(*order)
    after = of_version.rowsBetween(1, Window.unboundedFollowing)
    whole = F.col("kind").isin("message", "edit", "regenerate", "delete")
    marked = versions.withColumns({
        "nth": F.row_number().over(of_version),
        "stands": ~F.coalesce(F.max(whole).over(after), F.lit(False)),  # nothing later replaces it
    })
    text = F.when(F.col("kind").isin("message", "delta", "edit"), F.col("text")).otherwise("")
    parts = F.array_sort(F.collect_list(F.when(F.col("stands"), F.struct("nth", text.alias("text")))))
    turns = marked.groupBy("conv_id", "message", "version").agg(
        F.min_by("role", "nth").alias("role"),
        F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"),
        F.max(F.col("stands") & (F.col("kind") == "delete")).alias("_deleted"),
    )
    return turns.where("NOT _deleted").drop("_deleted")


def render(log: DataFrame) -> DataFrame:
    """conv_id, formatted, its segments (text, loss) in order, whose texts laid end to end are ``formatted``, and the mask.

    The mask has a row (turn, start, length) per turn under the loss: its characters ``start`` to ``start + length`` within turn
    number ``turn``, both from 0. Within the turn, so that texts under the mask are found in one pass over a long conversation.
    """
    head = F.concat(F.lit(START), escaped(F.col("role"), ROLE_ESCAPES), F.lit(COLON))
    turn = folded(log).select("conv_id", F.struct("message", "version", head.alias("head"), escaped(F.col("text")).alias("body"), F.col("role").isin(*LOSS_ROLES).alias("loss")).alias("turn"))
    turns = turn.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda x: F.array(F.struct(x["head"].alias("text"), F.lit(False).alias("loss")), F.struct(x["body"].alias("text"), x["loss"].alias("loss")), F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))))
    spans = F.transform("turns", lambda x, i: F.struct(i.alias("turn"), F.length(x["head"]).alias("start"), F.length(x["body"]).alias("length"), x["loss"].alias("loss")))
    mask = F.transform(F.filter(spans, lambda x: x["loss"]), lambda x: x.dropFields("loss"))
    return turns.select("conv_id", segments.alias("segments"), mask.alias("mask")).withColumn("formatted", F.array_join(F.transform("segments", lambda x: x["text"]), ""))


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    marks = F.filter(F.split(formatted, END), lambda x: x != "")  # what follows the last mark is empty
    bodies = F.transform(marks, lambda x: F.substring(x, F.lit(len(START) + 1), F.length(x)))

    def turn(body: Column) -> Column:
        role = F.substring_index(body, COLON, 1)
        text = F.substring(body, F.length(role) + len(COLON) + 1, F.length(body))
        return F.struct(unescaped(role, ROLE_ESCAPES).alias("role"), unescaped(text).alias("text"))

    return F.transform(bodies, turn)


def digests(rendered: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read from the rendered text and its mask."""
    turns = read_back(F.col("formatted"))
    cut = F.split("formatted", END)
    under_mask = F.array_join(F.transform("mask", lambda x: unescaped(F.substring(F.get(cut, x["turn"]), x["start"] + 1, x["length"]))), "")
    read = rendered.select("conv_id", turns.alias("turns"), under_mask.alias("loss"), F.length("formatted").cast("bigint").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


SQL = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
    SELECT *, length(replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\e'))
        + length(replace(replace(replace(replace(role, '\', '\s'), '###', '\h'), '</turn>', '\e'), ':', '\c')) + 14 AS chars
    FROM given)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""
