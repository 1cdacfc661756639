"""A question loop over a retrieval index. The chat call, if any, is the caller's; without one the context is the answer."""

from __future__ import annotations

import platform
import sys
from collections.abc import Callable

import pyspark
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.config import RetrievalConfig
from tidegrid.operators.retrieval import chat_messages, context_block, hashed_vector, search

LEAVE, FILES = {"exit", "quit"}, {"files", "list files", "show files"}


def environment() -> dict[str, str]:
    return {"python": sys.version.split()[0], "spark": pyspark.__version__, "platform": platform.platform()}


def files(index: DataFrame) -> list[str]:
    return [r.file_path for r in index.select("file_path").distinct().orderBy("file_path").collect()]


def retrieval_text(question: str, history: list[tuple[str, str]], keep: int) -> str:
    before = [q for q, _ in history[-keep:]] if keep else []
    return "\n\n".join([*before, f"Follow-up question: {question}"]) if before else question


def answer(index: DataFrame, question: str, history: list[tuple[str, str]], cfg: RetrievalConfig, embedder: Callable[[str], list[float]] = hashed_vector, chat: Callable[[list[dict]], str] | None = None) -> str:
    best = search(index, embedder(retrieval_text(question, history, cfg.max_history_turns)), "id", "embedding", cfg.top_k)
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "id")))  # top_k rows
    context = context_block(ranked).first().context
    return chat(chat_messages("Answer from the code below.", history, context, question, cfg.max_history_turns)) if chat else context


def converse(index: DataFrame, cfg: RetrievalConfig = RetrievalConfig(), ask: Callable[[str], str] = input, say: Callable[[str], None] = print, **how) -> list[tuple[str, str]]:
    """Until exit, quit or the end of input. Blank lines are ignored; the history keeps ``max_history_turns``."""
    history: list[tuple[str, str]] = []
    while True:
        try:
            question = ask("> ").strip()
        except EOFError:
            return history
        if question.lower() in LEAVE:
            return history
        if not question:
            continue
        if question.lower() in FILES:
            say("\n".join(files(index)))
            continue
        reply = answer(index, question, history, cfg, **how)
        say(reply)
        history = [*history, (question, reply)][-cfg.max_history_turns :]
