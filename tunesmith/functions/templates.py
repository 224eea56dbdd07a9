"""Prompt templates as Column expressions (evaluated in the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Template pieces that rendered text must reproduce exactly.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
QA_QUESTION = "### Question: "
QA_ANSWER = "\n ### Answer: "
CTX_INSTRUCTION = "Instruction: "
CTX_INPUT = "Input: "
CTX_ANSWER = "Answer: "
KTO_PROMPT_HEAD = "<|im_start|>user\nQ:"
KTO_PROMPT_TAIL = "\nA:<|im_end|>\n"
KTO_COMPLETION_HEAD = "<|im_start|>assistant\n"
KTO_COMPLETION_TAIL = "<|im_end|>\n"
CODE_EDIT_HEAD = "[INST] Code:```python\n"
CODE_EDIT_MIDDLE = "``` \n\n Question: "
CODE_EDIT_TAIL = " \n\n Modified code:[/INST]"
DIALOGUE_HUMAN = "\n\nHuman: "
DIALOGUE_ASSISTANT = "\n\nAssistant: "
DIALOGUE_MARKER = "\n\nAssistant:"
RESPONSE_MARKER = " ### Answer:"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def chatml_message(role, content) -> Column:
    """``<|im_start|>{role}\\n{content}<|im_end|>\\n``."""
    return F.concat(F.lit(IM_START), _c(role), F.lit("\n"), _c(content),
                    F.lit(IM_END + "\n"))


def generation_header(role: str = "assistant") -> Column:
    return F.lit(f"{IM_START}{role}\n")


def whole_message(role, content) -> Column:
    """A message that keeps its place: null role or content is empty, as a
    list of turns without one would pair the others wrongly."""
    return chatml_message(F.coalesce(_c(role), F.lit("")), F.coalesce(_c(content), F.lit("")))


def chatml(messages, add_generation_prompt: bool = False) -> Column:
    """Render an ``array<struct<role,content>>`` in ChatML; every element is a
    message, also a null one (:func:`whole_message`)."""
    body = F.array_join(
        F.transform(_c(messages),
                    lambda m: whole_message(m["role"], m["content"])), "")
    if add_generation_prompt:
        body = F.concat(body, generation_header())
    return body


def qa_prompt(instruction, output) -> Column:
    return F.concat(F.lit(QA_QUESTION), _c(instruction), F.lit(QA_ANSWER),
                    _c(output))


def context(instruction, input_) -> Column:
    """``Instruction: …\\n`` + optional ``Input: …\\n`` + ``Answer: ``."""
    inp = _c(input_)
    optional = F.when(F.coalesce(inp, F.lit("")) != "",
                      F.concat(F.lit(CTX_INPUT), inp, F.lit("\n"))
                      ).otherwise(F.lit(""))
    return F.concat(F.lit(CTX_INSTRUCTION), _c(instruction), F.lit("\n"),
                    optional, F.lit(CTX_ANSWER))


def kto_prompt(instruction) -> Column:
    return F.concat(F.lit(KTO_PROMPT_HEAD), _c(instruction),
                    F.lit(KTO_PROMPT_TAIL))


def kto_completion(answer) -> Column:
    return F.concat(F.lit(KTO_COMPLETION_HEAD), _c(answer),
                    F.lit(KTO_COMPLETION_TAIL))


def code_edit(code, question) -> Column:
    return F.concat(F.lit(CODE_EDIT_HEAD), _c(code), F.lit(CODE_EDIT_MIDDLE),
                    _c(question), F.lit(CODE_EDIT_TAIL))


def dialogue_piece(role, text) -> Column:
    """One turn of the Human/Assistant dialogue format (system is skipped)."""
    r = _c(role)
    return (F.when(r == "user", F.concat(F.lit(DIALOGUE_HUMAN), _c(text)))
             .when(r == "assistant",
                   F.concat(F.lit(DIALOGUE_ASSISTANT), _c(text))))


def upto_last_marker(text, marker: str = DIALOGUE_MARKER) -> Column:
    """Text up to and including the last ``marker``; null when absent."""
    t = _c(text)
    tail = F.substring_index(t, marker, -1)
    return F.when(F.instr(t, F.lit(marker)) > 0,
                  F.left(t, F.length(t) - F.length(tail)))
