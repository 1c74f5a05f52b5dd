"""Prompt text columns from templates, which are data: parsed when a plan is made.

They are filled in one pass, never by replacement, so a value that looks like a
placeholder stays as it is."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prompt texts, chunk template, roles and limits.
ANSWER_TEMPLATE = (
    "You are a trusted assistant that helps answer questions based only on the provided "
    "information. If you do not know the answer to a question, you truthfully say you do not "
    "know.  Here is some context which might or might not help you answer: {context}.  Answer "
    "directly, do not repeat the question, do not start with something like: the answer to the "
    "question, do not add AI in front of your answer, do not say: here is the answer, do not "
    "mention the context or the question. Based on this context, answer this question: {question}"
)
REWRITE_TEMPLATE = (
    "Based on the chat history below, we want you to generate a query for an external data "
    "source to retrieve relevant documents so that we can better answer the question. The query "
    "should be in natural language. The external data source uses similarity search to search "
    "for relevant documents in a vector space. So the query should be similar to the relevant "
    "documents semantically. Answer with only the query. Do not add explanation.\n\n"
    "Chat history: {chat_history}\n\nQuestion: {question}"
)
PASSAGE_TEMPLATE = "Passage: {chunk_text}\n"
INSTRUCT_TEMPLATE = "<s>[INST]<<SYS>>\n{system_prompt}\n<</SYS>>\n\n\n{instruction}[/INST]\n"
HISTORY_ROLES = ("user", "assistant")
PASSAGES = 3
MAX_ANSWER_TOKENS = 1500
MODEL_WINDOW = 4096
DEFAULT_TEMPERATURE = 1.0
DEFAULT_NEW_TOKENS = 100


@dataclass(frozen=True)
class Slot:
    """A place in a template that takes a value."""

    name: str


def parse_template(text: str, allowed: Iterable[str]) -> list[str | Slot]:
    """Literal pieces and slots of a template, in order; ``{{`` and ``}}`` are braces.

    A slot that is not ``allowed`` and a brace that is neither are errors.
    """
    allowed, pieces, literal = set(allowed), [], ""
    for found in re.finditer(r"\{\{|\}\}|\{(\w+)\}|[{}]|[^{}]+", text):
        token, name = found.group(), found.group(1)
        if name is not None:
            if name not in allowed:
                raise ValueError(f"unknown slot {name!r}; there are {sorted(allowed)}")
            pieces += [literal, Slot(name)] if literal else [Slot(name)]
            literal = ""
        elif token in ("{", "}"):
            raise ValueError(f"a lone brace at {found.start()} of the template")
        else:
            literal += token[0] if token in ("{{", "}}") else token
    return [*pieces, literal] if literal else pieces


def filled(pieces: list[str | Slot], **values: Column) -> Column:
    """The text of parsed pieces with the values in their slots."""
    columns = [values[p.name] if isinstance(p, Slot) else F.lit(p) for p in pieces]
    return F.concat(*columns) if columns else F.lit("")


def fill(template: str, **values: Column) -> Column:
    """The template with every ``{name}`` replaced by the column of that name."""
    return filled(parse_template(template, values), **values)


def around(template: str, slot: str, allowed: Iterable[str]) -> tuple[list[str | Slot], list[str | Slot]]:
    """What stands before and after the one place of ``slot``."""
    pieces = parse_template(template, allowed)
    at = [i for i, p in enumerate(pieces) if p == Slot(slot)]
    if len(at) != 1:
        raise ValueError(f"the template needs the slot {slot!r} once, not {len(at)} times")
    return pieces[: at[0]], pieces[at[0] + 1 :]


@dataclass(frozen=True)
class PromptTexts:
    """The templates of a chat chain, checked as soon as they are given.

    ``answer`` takes context and question, ``rewrite`` chat_history and question,
    ``passage`` chunk_text and document_uri, ``instruct`` system_prompt and instruction.
    """

    answer: str = ANSWER_TEMPLATE
    rewrite: str = REWRITE_TEMPLATE
    passage: str = PASSAGE_TEMPLATE
    instruct: str = INSTRUCT_TEMPLATE

    def __post_init__(self):
        parse_template(self.answer, ("context", "question"))
        parse_template(self.passage, ("chunk_text", "document_uri"))
        # Histories and instructions may be long, so they pass by in pieces, once.
        self.around_history()
        self.around_instruction()

    @classmethod
    def from_config(cls, config: Mapping[str, str]) -> PromptTexts:
        """From a mapping as a configuration file gives it; names it does not know are errors."""
        unknown = set(config) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown templates {sorted(unknown)}")
        return cls(**config)

    def around_history(self):
        return around(self.rewrite, "chat_history", ("chat_history", "question"))

    def around_instruction(self):
        return around(self.instruct, "instruction", ("system_prompt", "instruction"))

    def system_message(self, context: Column, question: Column) -> Column:
        return fill(self.answer, context=context, question=question)


def instruct_prompt(system_prompt: Column, instruction: Column) -> Column:
    return fill(INSTRUCT_TEMPLATE, system_prompt=system_prompt, instruction=instruction)
