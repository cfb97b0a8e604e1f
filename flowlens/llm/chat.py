"""Chat formatting with typed content parts, by DataFrame operations only.

A message has a role and an ordered list of parts. The visitor puts neighbouring text parts
together, turns each into escaped text and every attachment (image, audio, document) into a placeholder, and records the
reference and the number of tokens that the placeholder stands for. A turn is written as

    <|im_start|>ROLE newline BODY<|im_end|> newline

Control strings inside roles and texts get a caret after their first character; one that
already carries carets gets one more, so taking one away restores every text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, ROLE_NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
UNKNOWN = "<|unknown|>"
#: All strings a text must not hold as they are; with carets after the first character.
CONTROL = (r"(<)(\^*(?:/?s>|\|(?:im_start|im_end|nl|image|audio|document|unknown|endoftext)\|>))"
           r"|(\[)(\^*/?INST\])")
ESCAPED = CONTROL.replace(r"\^*", r"\^+")
#: Pixels of a side of an image patch, tokens a second of audio, and tokens a page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 12.5, 256

PART = ("struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "$1$3^$2$4")


def unescape(text: Column) -> Column:
    bare = ESCAPED.replace(r"(\^+", r"\^(\^*")
    return F.regexp_replace(text, bare, "$1$3$2$4")


def expanded_tokens(part: Column) -> Column:
    """Tokens that replace the placeholder of an attachment; missing sizes count as one unit."""
    def units(x, of):
        return F.greatest(F.lit(1), F.ceil(F.coalesce(x, F.lit(1)) / of))

    return (F.when(part.kind == "image", units(part.width, PATCH) * units(part.height, PATCH))
             .when(part.kind == "audio", F.greatest(F.lit(1), F.ceil(
                 F.coalesce(part.seconds, F.lit(0.0)) * AUDIO_RATE)))
             .when(part.kind == "document",
                   F.greatest(F.lit(1), F.coalesce(part.pages, F.lit(1))) * PAGE_TOKENS)
             .otherwise(F.lit(0))).cast("long")


def joined_texts(parts: Column) -> Column:
    """``parts`` with neighbouring text parts put together, so that no control string can form
    over the border of two of them."""
    def add(done, p):
        last = F.try_element_at(done, F.lit(-1))
        both = F.coalesce((p.kind == "text") & (last.kind == "text"), F.lit(False))
        whole = last.withField("text", F.concat(F.coalesce(last.text, F.lit("")),
                                                F.coalesce(p.text, F.lit(""))))
        return F.when(both, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(whole))
                      ).otherwise(F.array_append(done, p))

    return F.aggregate(parts, F.array().cast(f"array<{PART}>"), add)


def visit(parts: Column) -> tuple[Column, Column]:
    """The body of a message, and its attachments in order."""
    def placeholder(p):
        out = F.when(p.kind == "text", escape(F.coalesce(p.text, F.lit(""))))
        for kind, mark in PLACEHOLDERS.items():
            out = out.when(p.kind == kind, F.lit(mark))
        return out.otherwise(F.lit(UNKNOWN))

    known = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    known = F.when(F.size(known) > 1, joined_texts(known)).otherwise(known)
    attachments = F.transform(
        F.filter(known, lambda p: ~F.coalesce(p.kind == "text", F.lit(False))),
        lambda p: F.struct(p.kind.alias("kind"), p.ref.alias("ref"),
                           expanded_tokens(p).alias("tokens")))
    return F.array_join(F.transform(known, placeholder), ""), attachments


def text_parts(text: str) -> Column:
    """A message of one text part (null: empty)."""
    null = {f: F.lit(None).cast(t).alias(f) for f, t in
            (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"),
             ("pages", "int"))}
    return F.array(F.struct(F.lit("text").alias("kind"),
                            F.coalesce(F.col(text), F.lit("")).alias("text"), *null.values()))


def format_chats(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """``conv_id, n_turns, formatted, loss_mask, attachments, expanded_tokens``.

    ``messages`` has ``conv_id, turn, role, parts``; others are left out. Turns go by number,
    null first; ties by role, then body, so repeated rows stay as turns of their own. A null role
    is an empty one; rows of null ``conv_id`` form one conversation; no rows give none.
    ``loss_mask`` lists (turn, start, length) in code points, from the start of that turn.
    A conversation is one string, so its rows meet in one task, put together there from what
    each task has already gathered.
    """
    body, attachments = visit(F.col("parts"))
    role = F.coalesce("role", F.lit(""))
    rows = messages.select(
        "conv_id", F.struct(
            "turn", F.regexp_replace(escape(role), "\n", ROLE_NEWLINE).alias("role"),
            body.alias("body"), (role == loss_role).alias("loss"),
            attachments.alias("attachments")).alias("t"))
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = F.char_length(F.lit(START)) + 1
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(
            F.lit(START), t.role, F.lit("\n"), t.body, F.lit(END + "\n"))), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t, i: F.when(t.loss, F.struct(
            i.alias("turn"), (head + F.char_length(t.role)).alias("start"),
            F.char_length(t.body).alias("length")))), lambda m: m.isNotNull()).alias("loss_mask"),
        F.flatten("turns.attachments").alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate(
        "attachments", F.lit(0).cast("long"), lambda s, a: s + a.tokens))


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text) and ``loss_text``, taken from ``formatted`` and ``loss_mask`` alone."""
    pieces = F.split("formatted", r"<\|im_end\|>\n", -1)
    cut = formatted.withColumn("_turns", F.slice(pieces, 1, F.size(pieces) - 1))

    def parsed(turn):
        line = F.substring_index(turn, "\n", 1)
        role = F.regexp_replace(F.substr(line, F.lit(len(START) + 1)), r"<\|nl\|>", "\n")
        return F.struct(unescape(role).alias("role"),
                        unescape(F.substr(turn, F.char_length(line) + 2)).alias("text"))

    masked = F.transform("loss_mask", lambda m: unescape(
        F.substr(F.get("_turns", m.turn), m.start + 1, m.length)))
    return (cut.withColumn("turns", F.transform("_turns", parsed))
               .withColumn("loss_text", F.array_join(masked, "")).drop("_turns"))


def digests(messages: DataFrame) -> DataFrame:
    """Counts and digests of what the formatted conversations give back."""
    back = read_back(format_chats(messages))
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
