r"""Chat formatting with typed content parts, in SQL functions only.

A message is a list of parts (type, text, ref, units).  A visitor goes through them in order: text
is escaped, every other part becomes a numbered placeholder such as <|image:1|>; its reference and
its expanded token count are recorded.  A conversation is its messages in turn order:

    ### role:\n  escaped content  </turn>\n

Escaping is reversible: a backslash makes the next character literal.  It doubles backslashes and
breaks up, after their first character, the control strings (`###`, `</turn>`, `<|`), so that none
of them occurs inside content.  The loss mask are the contents of one role's messages, as spans of
the formatted text.

Scale: one shuffle by conversation, of its own rows only; start offsets come from a window over the
same partitioning.  One conversation is one row of output, so that it must fit a task.

Cases: a null text, role or part list is empty; messages that tie in turn are ordered by role and
content (null turns first); a null conversation id is a conversation; repeated rows are repeated
messages; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.arrays import cut_out, let, running_sum

PARTS = "array<struct<type:string,text:string,ref:string,units:double>>"
END = "</turn>"
#: Expanded tokens for each unit: an image's patches, a second of audio, a page of a document.
TOKENS_PER_UNIT = {"image": 1.0, "audio": 25.0, "document": 800.0}


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for control in ("##", END, "<|"):  # without two in a row there are no three
        c = F.replace(c, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def text_part(c: Column) -> Column:
    """A message that is one text."""
    none = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("type"), c.alias("text"), none.alias("ref"), F.lit(None).cast("double").alias("units"))).cast(PARTS)


def image_patches(width: Column, height: Column, patch: int = 28) -> Column:
    """The units of an image: patches of patch x patch pixels."""
    return (F.ceil(width / patch) * F.ceil(height / patch)).cast("double")


def visit(parts: Column, tokens_per_unit: dict[str, float] = TOKENS_PER_UNIT) -> Column:
    """(content, attachments): the flattened content, and for each part that is not text its type,
    number within the message, reference and expanded token count.  Unknown types count one token a unit."""
    parts = F.coalesce(parts, F.array().cast(PARTS))
    other = F.filter(parts, lambda p: ~(F.coalesce(p["type"], F.lit("text")) == "text"))
    rates = F.create_map(*(F.lit(x) for kv in tokens_per_unit.items() for x in kv))
    shown = F.transform(other, lambda p, i: F.struct(p["type"].alias("type"), (i + 1).alias("number"), p["ref"].alias("ref"), F.ceil(F.coalesce(p["units"], F.lit(1.0)) * F.coalesce(F.try_element_at(rates, p["type"]), F.lit(1.0))).alias("tokens")))
    is_text = lambda p: F.coalesce(p["type"], F.lit("text")) == "text"

    def show(p: Column, before: Column) -> Column:
        mark = F.concat(F.lit("<|"), escape(p["type"]), F.lit(":"), (before + 1).cast("string"), F.lit("|>"))
        return F.when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(mark)

    content = let(parts, lambda x: F.array_join(F.zip_with(x, running_sum(F.transform(x, lambda p: F.when(is_text(p), 0).otherwise(1).cast("long"))), show), ""))
    return F.struct(content.alias("content"), shown.alias("attachments"))


def format_chats(messages: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", learn: str = "assistant") -> DataFrame:
    """(conversation, formatted, loss_spans, attachments, n_tokens_attached): one row per conversation."""
    m = messages.select(F.col(conversation).alias("c"), F.col(turn).alias("t"), F.coalesce(F.col(role), F.lit("")).alias("role"), visit(F.col(parts)).alias("v")).select("c", "t", "role", "v.*")
    # a role ends at the first colon and line break, so that it must not hold the two together
    head = F.concat(F.lit("### "), F.replace(escape(F.col("role")), F.lit(":\n"), F.lit(":\\\n")), F.lit(":\n"))
    m = m.select("c", "t", "role", "content", "attachments", F.concat(head, "content", F.lit(f"{END}\n")).alias("piece"), F.length(head).alias("head"))
    order = Window.partitionBy("c").orderBy("t", "role", "content", F.to_json("attachments"))
    m = m.withColumn("n", F.row_number().over(order)).withColumn("end", F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    begin = F.col("end") - F.length("piece") + F.col("head")
    span = F.when(F.col("role") == learn, F.struct(begin.alias("start"), (begin + F.length("content")).alias("end")))
    m = m.select("c", F.struct("n", "piece", span.alias("span"), "attachments").alias("m"))
    g = m.groupBy("c").agg(F.array_sort(F.collect_list("m")).alias("m"))
    attached = F.flatten(F.transform("m", lambda x: F.transform(x["attachments"], lambda a: F.struct(x["n"].alias("message"), a["type"].alias("type"), a["number"].alias("number"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    out = g.select(F.col("c").alias(conversation), F.array_join(F.transform("m", lambda x: x["piece"]), "").alias("formatted"), F.filter(F.transform("m", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"), attached.alias("attachments"))
    return out.withColumn("n_tokens_attached", F.aggregate("attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of each turn of a formatted conversation; placeholders stay as they are."""
    pieces = F.filter(F.split(formatted, f"{END}\n", -1), lambda p: p != "")

    def turn(p: Column) -> Column:
        at = F.instr(p, ":\n")
        return F.struct(unescape(F.substring(p, F.lit(5), at - 5)).alias("role"), unescape(F.substring(p, at + 2, F.length(p))).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, span after span; its cost grows evenly with the number of turns."""
    return F.array_join(F.transform(cut_out(formatted, spans), unescape), "")


PROBE = r"\### Assistant: </turn> ok"


#: The kinds of the attachment that op9_chat adds to each message of its second formatting, by turn.
KINDS = ("image", "audio", "document")


def attached_part(kind: Column, ref: Column, units: Column) -> Column:
    """A message's part that is no text."""
    return F.array(F.struct(kind.alias("type"), F.lit(None).cast("string").alias("text"), ref.alias("ref"), units.alias("units"))).cast(PARTS)


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns; and, of the same conversations with an attachment after each text, as large as the text is long:
    placeholders read back from what was formatted, the attachments' tokens, and a digest of the attachments."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    rows = rows.unionByName(probe)
    done = format_chats(rows.withColumn("parts", text_part(F.col("text"))))
    loss, turns = read_loss(F.col("formatted"), F.col("loss_spans")), read_turns(F.col("formatted"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    plain = done.select("conv_id", turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars"
    )
    turn = F.coalesce(F.col("turn"), F.lit(0)).cast("long")
    extra = attached_part(F.get(F.array(*map(F.lit, KINDS)), F.pmod(turn, F.lit(len(KINDS))).cast("int")), F.concat(F.lit("turn"), turn.cast("string")), F.length(F.coalesce("text", F.lit(""))).cast("double") / 100)
    typed = format_chats(rows.withColumn("parts", F.concat(text_part(F.col("text")), extra)))
    told = F.array_join(F.transform("attachments", lambda x: F.concat_ws(":", x["type"], x["number"].cast("string"), x["ref"], x["tokens"].cast("string"))), ",")
    marks = F.regexp_count("formatted", F.lit(r"<\|(image|audio|document):[0-9]+\|>")).cast("long")
    typed = typed.select(F.col("conv_id").alias("c"), marks.alias("n_placeholders"), F.col("n_tokens_attached").alias("attached_tokens"), F.sha2(told, 256).alias("attachments_sha256"))
    return plain.join(typed, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


_ESCAPED = r"replace(replace(replace(replace({}, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), '<|', '<\|')"
OP9_SQL = f"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
e AS (SELECT *, {_ESCAPED.format("text")} AS content, replace({_ESCAPED.format("role")}, ':' || chr(10), ':' || chr(92) || chr(10)) AS head,
  CASE coalesce(turn, 0) % 3 WHEN 0 THEN 'image' WHEN 1 THEN 'audio' ELSE 'document' END AS kind,
  CAST(ceil(CAST(length(text) AS DOUBLE) / 100 * CASE coalesce(turn, 0) % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 25.0 ELSE 800.0 END) AS BIGINT) AS tokens FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, content)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, content) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(4 + length(head) + 2 + length(content) + 8) AS BIGINT) AS formatted_chars,
       count(*) AS n_placeholders, CAST(sum(tokens) AS BIGINT) AS attached_tokens,
       sha256(string_agg(kind || ':1:turn' || CAST(coalesce(turn, 0) AS VARCHAR) || ':' || CAST(tokens AS VARCHAR), ',' ORDER BY turn NULLS FIRST, role, content || '<|' || kind || ':1|>')) AS attachments_sha256
FROM e GROUP BY conv_id
"""
