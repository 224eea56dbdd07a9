"""Prompt shaping (PRM1-PRM12): narrow projections over the whole corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.functions import templates as T
from tunesmith.functions.text import words


def qa_prompt(df: DataFrame, instruction="instruction", output="output",
              out="prompt") -> DataFrame:
    """PRM1: ``### Question: {instruction}\\n ### Answer: {output}``."""
    return df.withColumn(out, T.qa_prompt(instruction, output))


def context_target(df: DataFrame, instruction="instruction", input_="input",
                   output="output") -> DataFrame:
    """PRM2: context with an optional ``Input:`` line; target = output."""
    return (df.withColumn("context", T.context(instruction, input_))
              .withColumn("target", F.col(output)))


def sft_text(df: DataFrame, instruction="instruction", output="output",
             out="text") -> DataFrame:
    """PRM3: instruction followed by the first answer."""
    return df.withColumn(out, F.concat(F.col(instruction),
                                       F.get(F.col(output), 0)))


def chatml(df: DataFrame, messages="messages", out="text",
           add_generation_prompt: bool = False) -> DataFrame:
    """PRM4: ChatML rendering of an ``array<struct<role,content>>``."""
    return df.withColumn(out, T.chatml(messages, add_generation_prompt))


def chatml_pair(df: DataFrame, chosen="chosen", rejected="rejected") -> DataFrame:
    """PRM5: ChatML over the chosen and rejected message lists."""
    return (df.withColumn(chosen, T.chatml(chosen))
              .withColumn(rejected, T.chatml(rejected)))


def chatml_kto(df: DataFrame, prompt="prompt", completion="completion") -> DataFrame:
    """PRM6: ChatML over the prompt and completion message lists."""
    return (df.withColumn(prompt, T.chatml(prompt))
              .withColumn(completion, T.chatml(completion)))


def system_question_pair(df: DataFrame, system="system", question="question",
                         chosen="chosen", rejected="rejected") -> DataFrame:
    """PRM7: optional system message + user question + generation header;
    answers end with ``<|im_end|>\\n``."""
    sys_msg = F.when(F.length(F.coalesce(F.col(system), F.lit(""))) > 0,
                     T.chatml_message(F.lit("system"), F.col(system))
                     ).otherwise(F.lit(""))
    prompt = F.concat(sys_msg, T.chatml_message(F.lit("user"), F.col(question)),
                      T.generation_header())
    return df.select(
        *[c for c in df.columns if c not in (system, question, chosen, rejected)],
        prompt.alias("prompt"),
        F.concat(F.col(chosen), F.lit(T.IM_END + "\n")).alias("chosen"),
        F.concat(F.col(rejected), F.lit(T.IM_END + "\n")).alias("rejected"))


def kto_tagged(df: DataFrame, instruction="instruction", answer="answer") -> DataFrame:
    """PRM8: tagged KTO prompt and completion."""
    return (df.withColumn("prompt", T.kto_prompt(instruction))
              .withColumn("completion", T.kto_completion(answer)))


def history_prompt(df: DataFrame, key="conv_id", turn="turn", role="role",
                   text="text", out="prompt",
                   add_generation_prompt: bool = True) -> DataFrame:
    """PRM9: for every turn, ChatML of the conversation up to that turn.

    A running window frame per conversation; the frame is one record (a
    conversation), never a table-wide group.
    """
    w = (Window.partitionBy(key).orderBy(turn)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    piece = T.whole_message(role, text)
    hist = F.array_join(F.collect_list(piece).over(w), "")
    if add_generation_prompt:
        hist = F.concat(hist, T.generation_header())
    return df.withColumn(out, hist)


def history_column(df: DataFrame, history="history", prompt="prompt", out="prompt",
                   max_tokens: int | None = None) -> DataFrame:
    """PRM9 for rows that carry their history: ChatML of an
    ``array<struct<user,assistant>>``, then the prompt and the generation header.

    With ``max_tokens`` the oldest exchanges go until the words of the rest fit;
    the prompt itself always stays.  Row by row: no window, and nothing is looked up
    for what is cut.  A null history is empty; null texts are empty messages.
    """
    pieces = F.transform(F.coalesce(F.col(history), F.array()), lambda h: F.concat(
        T.whole_message(F.lit("user"), h["user"]), T.whole_message(F.lit("assistant"), h["assistant"])))
    now = F.concat(T.whole_message(F.lit("user"), prompt), T.generation_header())
    rows = df.withColumns({"__pieces": pieces, "__now": now})
    kept = F.col("__pieces")
    if max_tokens is not None:
        rows = rows.withColumns({"__sizes": F.transform("__pieces", lambda p: F.size(words(p))),
                                 "__used": F.size(words("__now"))})

        def fits(acc, size):
            more = acc["open"] & (acc["used"] + size <= max_tokens)
            return F.struct(F.when(more, acc["used"] + size).otherwise(acc["used"]).alias("used"),
                            F.when(more, acc["n"] + 1).otherwise(acc["n"]).alias("n"), more.alias("open"))

        start = F.struct(F.col("__used").alias("used"), F.lit(0).alias("n"), F.lit(True).alias("open"))
        rows = rows.withColumn("__n", F.aggregate(F.reverse("__sizes"), start, fits, lambda a: a["n"]))
        kept = F.slice("__pieces", F.size("__pieces") - F.col("__n") + 1, F.col("__n"))
    return rows.withColumn(out, F.concat(F.array_join(kept, ""), "__now")).drop(
        "__pieces", "__now", "__sizes", "__used", "__n")


def code_edit_prompt(df: DataFrame, code="code", question="question",
                     out="prompt") -> DataFrame:
    """PRM10: ``[INST] Code:`` + fenced code + question + ``[/INST]``."""
    return df.withColumn(out, T.code_edit(code, question))


def chat_requests(df: DataFrame, model: str, prompt="prompt",
                  out="payload") -> DataFrame:
    """PRM11: JSON chat-request payload per prompt (no network call)."""
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(F.struct(F.lit("user").alias("role"),
                         F.col(prompt).alias("content"))).alias("messages"))
    return df.withColumn(out, F.to_json(body))


def dialogue_prompt(df: DataFrame, text="text", marker=T.DIALOGUE_MARKER,
                    strict: bool = False, out="prompt") -> DataFrame:
    """PRM12: text up to and including the last marker.  Rows without the
    marker get a null prompt and ``prompt_ok = false`` (or raise with
    ``strict``)."""
    found = F.instr(F.col(text), F.lit(marker)) > 0
    value = T.upto_last_marker(text, marker)
    if strict:
        value = F.when(found, value).otherwise(
            F.raise_error(F.lit(f"prompt does not contain {marker!r}")))
    return df.withColumn(out, value).withColumn("prompt_ok", found)
