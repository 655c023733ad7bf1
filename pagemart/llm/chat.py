"""Chat formatting by perspective rotation.

A dialogue of several speakers is rendered once for each of them: that speaker is the assistant, the others
are named users, and the mask marks what the assistant says. All of it is DataFrame operations.

Messages are put in order once, by a range sort that may cut a long dialogue anywhere, and written; a
message's number in its dialogue is its place in the partition plus what earlier partitions hold of the
dialogue. Dialogues are rendered in parts of a set number of messages, so none needs to fit into one row; each
part says where it lies in the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemart.llm.base import query, table
from pagemart.operators import scans
from pagemart.session import materialise

PART = 64
SYSTEM = "system"
UNNAMED = "unknown"
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def numbered(messages: DataFrame, conv_col: str, turn_col: str, speaker_col: str, text_col: str) -> DataFrame:
    """(conv, turn, speaker, text, no): messages with their number in the dialogue, from 1.

    Order: turn (null last), speaker, text. Equal messages are interchangeable.
    """
    clean = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    name = F.regexp_replace(F.coalesce(F.col(speaker_col).cast("string"), F.lit(UNNAMED)), "\\s+", " ")
    rows = messages.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), clean(name).alias("speaker"),
        clean(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"), F.monotonically_increasing_id().alias("tie"),
    )
    ordered = rows.orderBy("conv", F.col("turn").asc_nulls_last(), "speaker", "text", "tie")
    place = F.monotonically_increasing_id()
    ordered = materialise(ordered.select("*", F.shiftright(place, 33).alias("run"), place.bitwiseAND((1 << 33) - 1).alias("at")), "ordered")
    runs = ordered.groupBy("conv", "run").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    # One row for each partition that holds some of the dialogue.
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select(
        F.col("conv").alias("own"), F.col("run").alias("own_run"), "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    joined = ordered.join(before, F.col("conv").eqNullSafe(F.col("own")) & (F.col("run") == F.col("own_run")))
    return joined.select("conv", "turn", "speaker", "text", (F.col("at") - F.col("first") + F.col("before") + 1).alias("no"))


def role_seen(speaker: Column, perspective: Column) -> Column:
    role = F.when(speaker == SYSTEM, F.lit("system")).when(speaker == perspective, F.lit("assistant"))
    return F.coalesce(role, F.concat(F.lit("user name="), speaker))


def places_of_parts(number: DataFrame, part: int) -> DataFrame:
    """(own, own_part, perspective, message_offset, text_offset): where each part lies in the dialogue as a speaker sees it.

    Lengths are added up from counts alone: a part is as long as for an outsider, and shorter or longer by what the
    speaker's own role takes instead of the name.
    """
    rows = number.select("conv", F.floor((F.col("no") - 1) / part).alias("part"), "speaker", F.length("text").cast("long").alias("said"))
    nobody = role_seen(F.col("speaker"), F.lit(None).cast("string"))
    frame = F.lit(len(BEGIN) + 1 + len(END)) + F.length(nobody)
    counts = rows.groupBy("conv", "part", "speaker").agg(
        F.sum(F.col("said") + frame).alias("outside"), (F.count(F.lit(1)) * (len("assistant") - F.length(nobody))).alias("change")
    )
    counts = materialise(counts, "part-lengths")
    lengths = counts.groupBy("conv", "part").agg(F.sum("outside").alias("outside"))
    speakers = counts.where(F.col("speaker") != SYSTEM).select(F.col("conv").alias("own"), F.col("speaker").alias("perspective")).distinct()
    seen = lengths.join(speakers, F.col("conv").eqNullSafe(F.col("own"))).drop("own")
    changes = counts.select(F.col("conv").alias("own"), F.col("part").alias("own_part"), "speaker", "change")
    same = F.col("conv").eqNullSafe(F.col("own")) & (F.col("part") == F.col("own_part")) & (F.col("perspective") == F.col("speaker"))
    seen = seen.join(changes, same, "left").select("conv", "part", "perspective", (F.col("outside") + F.coalesce("change", F.lit(0))).alias("long"))
    summed = scans.running(seen, ["conv", "perspective"], "part", "part", upto=("sum", F.col("long")))
    return summed.select(
        F.col("conv").alias("own"), F.col("part").alias("own_part"), "perspective",
        (F.col("part") * part).alias("message_offset"), (F.col("upto") - F.col("long")).alias("text_offset"),
    )


def perspectives(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text",
    part: int = PART,
) -> DataFrame:
    """(conv, perspective, part, message_offset, text_offset, n_messages, text, mask): each dialogue as each speaker sees it.

    ``mask`` has the (begin, end) places in the part's text, in characters, that the assistant is trained on:
    what it says, with the end mark. Parts of one dialogue follow each other; only dialogues of over ``part``
    messages have several. ``message_offset`` and ``text_offset`` are the messages and the characters of the dialogue
    before the part, so the parts' texts joined give the whole, and a mask's place plus ``text_offset`` its place there.
    ``system`` is no speaker: its messages are shown to all, and a dialogue of them
    alone has no perspective. A null speaker is ``unknown``, a null text empty, a null dialogue id one more
    dialogue. Repeated messages are each shown. ``<|`` in names and texts becomes ``< |``, so that no
    message can forge a mark. An empty table gives no rows; other columns are not read.
    """
    number = materialise(numbered(messages, conv_col, turn_col, speaker_col, text_col), "numbered")
    message = F.struct("no", "speaker", "text")
    parts = number.groupBy("conv", F.floor((F.col("no") - 1) / part).alias("part")).agg(F.array_sort(F.collect_list(message)).alias("messages"))
    seen = parts.join(places_of_parts(number, part), F.col("conv").eqNullSafe(F.col("own")) & (F.col("part") == F.col("own_part")))

    def head(m):
        return F.concat(F.lit(BEGIN), role_seen(m.speaker, F.col("perspective")), F.lit("\n"))

    said = seen.withColumn("heads", F.transform("messages", head)).withColumn(
        "bodies", F.transform("messages", lambda m: F.concat(m.text, F.lit(END)))
    )
    said = said.withColumn("pieces", F.zip_with("heads", "bodies", lambda h, b: F.concat(h, b)))
    ends = F.transform("pieces", lambda p, i: F.aggregate(F.slice("pieces", 1, i + 1), F.lit(0), lambda sum_, q: sum_ + F.length(q)))
    said = said.withColumn("ends", ends)
    spans = F.transform(
        "messages",
        lambda m, i: F.when(
            m.speaker == F.col("perspective"),
            F.struct((F.get("ends", i) - F.length(F.get("bodies", i))).alias("begin"), F.get("ends", i).alias("end")),
        ),
    )
    return said.select(
        F.col("conv").alias(conv_col), "perspective", "part", "message_offset", "text_offset", F.size("messages").cast("long").alias("n_messages"),
        F.array_join("pieces", "").alias("text"), F.filter(spans, lambda s: s.isNotNull()).alias("mask"),
    )


ORACLE = f"""
WITH named AS (
  SELECT conv_id, turn, replace(regexp_replace(coalesce(role, '{UNNAMED}'), '\\s+', ' ', 'g'), '<|', '< |') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS said FROM conversations),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker, said) AS no FROM named),
speakers AS (SELECT DISTINCT conv_id, speaker AS perspective FROM named WHERE speaker <> '{SYSTEM}'),
pieces AS (
  SELECT n.conv_id, perspective, (no - 1) // {PART} AS part, no, speaker = perspective AS own, said || '{END[:-1]}' || chr(10) AS body,
         '{BEGIN}' || CASE WHEN speaker = '{SYSTEM}' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                           ELSE 'user name=' || speaker END || chr(10) AS head
  FROM numbered n JOIN speakers s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY no) AS stop FROM pieces)
SELECT conv_id, perspective, part, part * {PART} AS message_offset,
       (sum(sum(length(head) + length(body))) OVER (PARTITION BY conv_id, perspective ORDER BY part) - sum(length(head) + length(body)))::BIGINT AS text_offset,
       count(*) AS n_messages, string_agg(head || body, '' ORDER BY no) AS text,
       coalesce(string_agg((stop - length(body))::BIGINT || '-' || stop::BIGINT, ' ' ORDER BY no) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, perspective, part"""


@query("op9_perspectives", ORACLE)
def op9_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat(s.begin.cast("string"), F.lit("-"), s.end.cast("string")))
    return seen.withColumn("mask", F.array_join(spans, " "))
