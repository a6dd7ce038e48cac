"""Dialogues told from every participant's side.

For each speaker of a conversation the whole dialogue is rendered once: that
speaker's turns as the assistant's, everybody else's as turns of named users,
system turns as they are. The mask lists where the assistant speaks, which is
what a model should learn from that rendering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from camlytics.llm.common import running

#: Turns per rendered part; a longer dialogue goes on in the next part.
PART_TURNS = 64
SYSTEM, NOBODY = "system", "unknown"
# The markers of the rendered format.
OPEN, CLOSE, BREAK = "<|im_start|>", "<|im_end|>", "\n"


def _header(role: Column, speaker: Column) -> Column:
    return (
        F.when(role == SYSTEM, F.lit(f"{OPEN}system{BREAK}"))
        .when(role == speaker, F.lit(f"{OPEN}assistant{BREAK}"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), role, F.lit(BREAK)))
    )


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """conv_id, speaker, part, n_turns, n_masked, text, mask.

    One row per conversation, participant and part of ``part_turns`` turns;
    parts in order make up the whole dialogue, so a conversation of any length
    lies in no single task. ``mask`` lists start:end in code points of the
    part's text, from the assistant's first character to the end of its closing
    marker.

    Turns go by number, null numbers last, ties by role and text; repeated rows
    count once. A null role is ``unknown``, a null text is empty, rows without
    conversation id form one conversation. "<|" inside a text is written
    "< |", so that no text can forge a marker. A conversation of system turns
    alone has one rendering, with a null speaker and nothing masked. Other
    columns are not read.
    """
    clean = turns.select(
        F.col("conv_id"), F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(NOBODY)).alias("role"),
        F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("text"),
    ).distinct().withColumns({
        "_key": F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")), "_one": F.lit(1)
    })
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc(), F.col("text").asc()]
    ranked = running(clean, order, "_one", "turns", key="_key")
    spoken = F.col("role") != SYSTEM
    # One row per conversation and role; a conversation without participants keeps a null speaker.
    roles = ranked.groupBy("_key", F.when(spoken, F.col("role")).alias("speaker")).agg(F.count(F.lit(1)).alias("_n"))
    several = F.count("speaker").over(Window.partitionBy("_key"))
    speakers = roles.withColumn("_speakers", several).where("speaker is not null or _speakers = 0").select("_key", "speaker")
    parts = ranked.groupBy("_key", "conv_id", F.expr(f"cast(_rank div {part_turns} as int)").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("_rank", "role", "text"))).alias("turns")
    )
    speaker = F.col("speaker")
    told = parts.join(speakers, "_key").withColumn("told", F.transform("turns", lambda t: F.struct(
        _header(t["role"], F.coalesce(speaker, F.lit(""))).alias("head"),
        F.concat(t["text"], F.lit(CLOSE)).alias("body"),
        F.coalesce(t["role"] == speaker, F.lit(False)).alias("learn"),
    )))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def walk(s: Column, t: Column) -> Column:
        start = s["at"] + F.length(t["head"])
        end = start + F.length(t["body"])
        span = F.concat_ws(":", start, end)
        return F.struct(
            (end + len(BREAK)).alias("at"),
            F.when(t["learn"], F.array_append(s["spans"], span)).otherwise(s["spans"]).alias("spans"),
        )

    spans = F.aggregate("told", begin, walk, lambda s: s["spans"])
    return told.withColumn("spans", spans).select(
        "conv_id", "speaker", "part",
        F.size("told").alias("n_turns"),
        F.size("spans").alias("n_masked"),
        F.array_join(F.transform("told", lambda t: F.concat(t["head"], t["body"], F.lit(BREAK))), "").alias("text"),
        F.array_join("spans", ",").alias("mask"),
    )


ORACLE = f"""
with clean as (
  select distinct conv_id, turn, coalesce(role, '{NOBODY}') as role, replace(coalesce(text, ''), '<|', '< |') as text
  from conversations),
ranked as (
  select *, row_number() over (partition by conv_id order by turn nulls last, role, text) - 1 as place from clean),
speakers as (
  select distinct conv_id, role as speaker from clean where role <> '{SYSTEM}'
  union all
  select conv_id, null from clean group by conv_id having count(*) = count(*) filter (role = '{SYSTEM}')),
told as (
  select r.conv_id, s.speaker, r.place // {PART_TURNS} as part, r.place, coalesce(r.role = s.speaker, false) as learn,
    case when r.role = '{SYSTEM}' then '{OPEN}system' when r.role = s.speaker then '{OPEN}assistant'
      else '{OPEN}user name=' || r.role end || chr(10) as head,
    r.text || '{CLOSE}' as body
  from ranked r join speakers s on r.conv_id is not distinct from s.conv_id),
placed as (
  select *, coalesce(sum(length(head) + length(body) + 1) over (
    partition by conv_id, speaker, part order by place rows between unbounded preceding and 1 preceding), 0)
    + length(head) as start from told)
select conv_id, speaker, cast(part as integer) as part, cast(count(*) as integer) as n_turns,
  cast(count(*) filter (learn) as integer) as n_masked,
  string_agg(head || body || chr(10), '' order by place) as text,
  coalesce(string_agg(cast(cast(start as bigint) as varchar) || ':' || cast(cast(start as bigint) + length(body) as varchar), ','
    order by place) filter (learn), '') as mask
from placed group by conv_id, speaker, part"""
