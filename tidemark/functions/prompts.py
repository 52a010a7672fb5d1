"""Prompt texts, verdict parsing and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

# Evaluation prompt parts, generation settings and verdict defaults.
QUESTION_PREFIX = "Answer the question: "
CONTEXT_PREFIX = " Context: "
GENERATION_SETTINGS = {"max_output_tokens": 8192, "temperature": 1.0, "top_p": 0.95, "seed": 0}
CHAT_GENERATION_SETTINGS = {"max_output_tokens": 2048, "temperature": 0.9, "top_p": 0.95, "seed": 0}
SAFETY_CATEGORIES = ("HATE_SPEECH", "DANGEROUS_CONTENT", "SEXUALLY_EXPLICIT", "HARASSMENT")
SAFETY_THRESHOLD = "OFF"
CORPUS_INSTRUCTION = ("You are a helpful assistant who can answer questions about the products in the corpus "
                      "and other assorted questions.")
BLANK_QUERY_STATUS = "请输入查询内容"
UNKNOWN = "未知"

# Templates with {slot} names. The wording is this package's own.
FACT_CHECK_TEMPLATE = (
    "Check whether the answer is fully based on the context and answers the query.\n\n"
    "Query: {query}\n\nContext:\n{retrieved_context}\n\nAnswer:\n{generated_answer}\n\n"
    'Reply as JSON with the fields "fidelity", "relevance", "hallucination" (是/否) and "reasoning".')
RELEVANCE_TEMPLATE = (
    "Score from 5 (fully relevant) to 1 (irrelevant) how relevant the answer is to the prompt. "
    "Explain each step.\n\n## Prompt\n{prompt}\n\n## Answer\n{response}\n")


def question_prompt(question: Column, context: Column) -> Column:
    return F.concat(F.lit(QUESTION_PREFIX), question, F.lit(CONTEXT_PREFIX), context)


def render(template: str, **slots: Column) -> Column:
    """Fill the named ``{slot}`` places of a template; a null value fills in nothing.

    The template is cut at its slots first, so a value that itself contains
    slot-like text is left as it is.
    """
    parts: list[str | Column] = [template]
    for name, value in slots.items():
        marker, cut = "{" + name + "}", []
        for part in parts:
            if isinstance(part, str):
                pieces = part.split(marker)
                cut.append(pieces[0])
                for piece in pieces[1:]:
                    cut += [F.coalesce(value, F.lit("")), piece]
            else:
                cut.append(part)
        parts = cut
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def verdict(raw: Column) -> Column:
    """Struct (fidelity, relevance, hallucination, reasoning, error) of a judge's reply.

    Code fences are removed first. Text that is no JSON gives the unknown mark in
    the three judgement fields and an error text.
    """
    bare = F.replace(F.replace(strip(raw), F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))
    root = F.try_parse_json(bare)

    def field(name: str) -> Column:
        return F.try_variant_get(root, f"$.{name}", "string")

    failed = root.isNull()
    judged = [F.when(failed, F.lit(UNKNOWN)).otherwise(field(n)).alias(n)
              for n in ("fidelity", "relevance", "hallucination")]
    error = F.when(failed, F.concat(F.lit("not JSON: "), F.coalesce(raw, F.lit("")))).otherwise(field("error"))
    return F.struct(*judged, field("reasoning").alias("reasoning"), error.alias("error"))


def decimals(value: Column, places: int) -> Column:
    """Number as text with a fixed count of decimals."""
    return F.format_string(f"%.{places}f", value.cast("double"))


def generation_settings(settings: dict[str, float] | None = None) -> Column:
    pairs = [F.lit(x) for k, v in (settings or GENERATION_SETTINGS).items() for x in (k, float(v))]
    return F.create_map(*pairs)


def safety_settings() -> Column:
    return F.create_map(*[F.lit(x) for c in SAFETY_CATEGORIES for x in (c, SAFETY_THRESHOLD)])
