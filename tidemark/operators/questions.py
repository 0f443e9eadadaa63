"""Question logs as tables: routing, dialog context, citations and answer quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.labels import first_match
from tidemark.functions.text import has_stems, has_words
from tidemark.operators.ordering import number_within, oversized_groups

# The routes in the order they are tried, with the stems and whole
# phrases that select them.
ROUTES: list[tuple[str, list[str], list[str]]] = [
    (
        "raw_sets",
        [],
        ["last workout", "last session", "yesterday", "what did i do", "sets i did", "today's workout"],
    ),
    (
        "pr",
        [],
        [
            "pr", "prs", "1rm", "personal record", "personal best", "heaviest", "max weight",
            "best lift", "one rep max",
        ],
    ),
    (
        "fatigue",
        ["overtrain", "deload", "fatigue", "recover", "burnout"],
        ["tired", "rest day", "should i rest", "burnt out", "burned out"],
    ),
    (
        "strength",
        ["stronger", "progress", "plateau", "improv", "gain", "e1rm"],
        ["getting stronger"],
    ),
    ("volume", ["neglect"], ["which muscle", "which muscles", "what muscle", "what muscles"]),
    ("balance", ["balance", "imbalance", "symmetr"], ["push", "pull", "ratio", "split"]),
    ("volume", ["volume", "hypertroph", "grow"], ["sets", "enough", "mev", "mav"]),
    (
        "sessions",
        ["session", "frequen", "consisten"],
        ["how often", "last week", "recent", "this week"],
    ),
]
NO_ROUTE = "llm"

# How many earlier answers, characters and messages a context holds.
CONTEXT_ANSWERS = 3
ANSWER_CHARS = 300
CONTEXT_MESSAGES = 6
EVIDENCE_CHARS = 500


def _text(column: str) -> Column:
    """A missing text is an empty one: its line must not be lost."""
    return F.coalesce(F.col(column), F.lit(""))


def route(text: Column, routes: Sequence[tuple[str, list[str], list[str]]] = tuple(ROUTES)) -> Column:
    """Name of the first of ``routes`` (name, stems, whole phrases) whose words occur in the question."""
    lowered = F.lower(text)
    rules = []
    for label, stems, words in routes:
        tests = ([has_stems(lowered, stems)] if stems else []) + ([has_words(lowered, words)] if words else [])
        rules.append((tests[0] | tests[1] if len(tests) == 2 else tests[0], label))
    return first_match(rules, NO_ROUTE)


def route_questions(
    df: DataFrame, text: str, out: str = "route", routes: Sequence[tuple[str, list[str], list[str]]] = tuple(ROUTES)
) -> DataFrame:
    return df.withColumn(out, route(F.col(text), routes))


def answer_pairs(messages: DataFrame, conv: str, turn: str, role: str, text: str, block: int = 4096) -> DataFrame:
    """Each assistant message with the user message directly before it as its question."""
    placed = _placed(messages, conv, turn)
    beside = Window.partitionBy(conv, "_block").orderBy("_pos")
    paired = _with_halo(placed, reach=1, block=block).select(
        conv, turn, role, F.col(text), "_own",
        F.when(F.lag(role).over(beside) == "user", F.lag(text).over(beside)).alias("question"),
    )
    return paired.filter((F.col(role) == "assistant") & F.col("_own")).select(
        conv, turn, F.coalesce("question", F.lit("")).alias("question"), F.col(text).alias("answer")
    )


def answer_history(
    asked: DataFrame,
    answers: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    keep: int = CONTEXT_ANSWERS,
    chars: int = ANSWER_CHARS,
) -> DataFrame:
    """Per question, its last ``keep`` good answers as ``user: .. / assistant: ..`` lines.

    ``answers`` holds (conv, turn, question, answer, is_error) and may hold
    ``resolved``, the question as it was understood, which is shown in place of the
    plain one where it is not NULL. Good answers get
    an ordinal per conversation; a question needs the ordinals just below its
    own place, an equi-join on (conversation, ordinal) that no single long
    conversation can overload.
    """
    asked_as = F.coalesce("resolved", "question") if "resolved" in answers.columns else F.col("question")
    good = answers.filter(~F.col("is_error")).select(conv, turn, asked_as.alias("question"), "answer")
    both = asked.select(conv, turn, F.lit(0).alias("_good")).unionByName(
        good.select(conv, turn, F.lit(1).alias("_good"))
    )
    big = oversized_groups(both, [conv])
    # Place among questions and answers minus place among questions = answers before it.
    place = number_within(both, [conv], [F.col(turn), F.col("_good")], "_all", big)
    among = number_within(asked.select(conv, turn), [conv], [F.col(turn)], "_asked", big)
    wanted = (
        place.filter("_good = 0")
        .join(among, [conv, turn])
        .select(conv, turn, (F.col("_all") - F.col("_asked")).alias("_seen"))
    )
    ordinals = number_within(good, [conv], [F.col(turn)], "_nth", big)
    lookback = wanted.filter("_seen > 0").select(
        conv,
        F.col(turn).alias("_at"),
        F.explode(F.sequence(F.greatest(F.col("_seen") - keep + 1, F.lit(1)), F.col("_seen"))).alias("_nth"),
    )
    line = F.concat(
        F.lit("user: "), _text("question"), F.lit("\nassistant: "), F.substring(_text("answer"), 1, chars)
    )
    context = (
        lookback.join(ordinals, [conv, "_nth"])
        .groupBy(conv, "_at")
        .agg(F.array_sort(F.collect_list(F.struct("_nth", line.alias("line")))).alias("_lines"))
        .select(
            conv,
            F.col("_at").alias(turn),
            F.size("_lines").cast("int").alias("n_answers"),
            F.array_join(F.col("_lines.line"), "\n").alias("history"),
        )
    )
    return (
        asked.select(conv, turn)
        .join(context, [conv, turn], "left")
        .select(
            conv,
            turn,
            F.coalesce("n_answers", F.lit(0)).alias("n_answers"),
            F.coalesce("history", F.lit("")).alias("history"),
        )
    )


def recent_messages(
    messages: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    keep: int = CONTEXT_MESSAGES,
    block: int = 4096,
) -> DataFrame:
    """Per message, the ``keep`` messages before it as ``role: content`` lines."""
    placed = _placed(messages, conv, turn)
    line = F.concat(_text(role), F.lit(": "), _text(text))
    before = Window.partitionBy(conv, "_block").orderBy("_pos").rowsBetween(-keep, -1)
    return (
        _with_halo(placed, reach=keep, block=block)
        .withColumn("context", F.array_join(F.collect_list(line).over(before), "\n"))
        .filter("_own")
        .select(conv, turn, role, "context")
    )


def _placed(messages: DataFrame, conv: str, turn: str) -> DataFrame:
    big = oversized_groups(messages, [conv])
    return number_within(messages, [conv], [F.col(turn)], "_pos", big)


def _with_halo(placed: DataFrame, reach: int, block: int) -> DataFrame:
    """Cut a long conversation into blocks; the last ``reach`` rows also precede the next block."""
    number = ((F.col("_pos") - 1) / F.lit(block)).cast("bigint")
    at_end = F.pmod(F.col("_pos") - 1, F.lit(block)) >= block - reach
    blocks = F.when(at_end, F.array(number, number + 1)).otherwise(F.array(number))
    return placed.withColumn("_block", F.explode(blocks)).withColumn("_own", F.col("_block") == number)


def cited_items(asked: DataFrame, evidence: DataFrame, query_id: str = "query_id") -> DataFrame:
    """Evidence rows an answer cites, by original number, each once and in order.

    ``asked`` holds (query_id, sources_used array of int); ``evidence`` holds
    numbered rows (query_id, rank, ...). A number without evidence is dropped.
    """
    numbers = F.array_sort(F.array_distinct(F.filter("sources_used", lambda i: i >= 1)))
    cited = asked.select(query_id, F.explode(numbers).alias("rank"))
    return evidence.join(cited, [query_id, "rank"]).withColumnRenamed("rank", "citation")


def evidence_context(
    evidence: DataFrame, query_id: str = "query_id", title: str = "title", body: str = "content",
    chars: int = EVIDENCE_CHARS,
) -> DataFrame:
    """Numbered evidence per query as one text. A query has at most k ranked rows."""
    entry = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] "), _text(title), F.lit("\n"), F.substring(_text(body), 1, chars)
    )
    listed = F.array_sort(F.collect_list(F.struct("rank", entry.alias("entry"))))
    return evidence.groupBy(query_id).agg(F.array_join(listed["entry"], "\n\n").alias("context"))


def answer_quality(runs: DataFrame) -> DataFrame:
    """Label each logged run.

    Columns read: asked_data, data_error, data_rows, asked_papers, paper_rows, n_notes.
    """
    no_data = F.col("asked_data") & (F.col("data_error") | (F.coalesce("data_rows", F.lit(0)) == 0))
    no_papers = F.col("asked_papers") & (F.coalesce("paper_rows", F.lit(0)) == 0)
    label = first_match([(no_data, "low"), (no_papers, "low"), (F.col("n_notes") > 0, "medium")], "high")
    return runs.withColumn("confidence", label)
