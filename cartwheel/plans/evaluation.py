"""Answers to known questions, and the harness that scores them.

Question and statement sets are small documents, so the loops below run over a few dozen entries; each entry is a
Spark query over the views.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from cartwheel.operators import adhoc, guard

Star = Mapping[str, DataFrame]
#: what answers a known question, by the name it is registered under
BUILDERS: dict[str, Callable[[Star], DataFrame]] = {
    "fnb_revenue_2024": lambda star: adhoc.star_revenue(star, 2024),
    "fnb_top5_products": adhoc.star_top_products,
    "fnb_city_2025": lambda star: adhoc.star_revenue_by_city(star, 2025),
    "fnb_orders_2025": lambda star: adhoc.star_orders(star, 2025),
    "fnb_by_method": adhoc.star_by_method,
    "fnb_by_tier_2024": lambda star: adhoc.star_by_tier(star, 2024),
    "fnb_monthly_2025": lambda star: adhoc.star_monthly(star, 2025),
    "fnb_top3_stores": adhoc.star_top_stores,
    adhoc.FALLBACK: lambda star: adhoc.top_price(
        star["DimProduct"].select("ProductKey", "ProductName", "Category", "BasePrice"), "BasePrice", "ProductKey"),
}


def ask(question: str, views: Star, statements: Mapping[str, str] | None = None) -> DataFrame:
    """The answer to a question: by the statement that a loaded document prepares for it (its normal form), which goes
    through the guard; else by the registered query for it; else by the fallback."""
    key = re.sub(r"\s+", " ", question.strip().lower())
    if statements and key in statements:
        return guard.guarded_sql(views, statements[key]).rows
    return BUILDERS[adhoc.CANNED.get(key, adhoc.FALLBACK)](views)


def run_questions(questions: DataFrame, views: Star, statements: Mapping[str, str] | None = None) -> DataFrame:
    """Answer each question and compare with its own statement, as multisets of rows; input of ``eval_scoreboard``."""
    rows = []
    for entry in questions.collect():
        began, passed = time.monotonic(), False
        try:
            answer = ask(entry.question, views, statements)
            wanted = guard.guarded_sql(views, entry.sql).rows
            passed = adhoc.result_difference(answer, wanted).isEmpty()
        except guard.Refused:
            pass
        rows.append((entry.question, entry.difficulty, passed, int((time.monotonic() - began) * 1000)))
    return questions.sparkSession.createDataFrame(rows, "Question string, Difficulty string, Passed boolean, LatencyMs long")


def score_asked(log: DataFrame, questions: DataFrame, views: Star, statements: Mapping[str, str] | None = None) -> DataFrame:
    """The log (Question, LatencyMs) with Difficulty and Passed, for questions of the set; each is answered once.

    The set is a small document, so its outcomes are broadcast and the log stays where it is.
    """
    told = run_questions(questions, views, statements).select(
        adhoc.normal_question(F.col("Question")).alias("_normal"), "Difficulty", "Passed").dropDuplicates(["_normal"])
    return (log.withColumn("_normal", adhoc.normal_question(F.col("Question"))).join(F.broadcast(told), "_normal")
            .select("Difficulty", "Passed", "LatencyMs"))


def run_statements(cases: DataFrame, views: Mapping[str, DataFrame]) -> DataFrame:
    """Put each statement to the guard; input of ``safety_scoreboard``."""
    rows = []
    for case in cases.collect():
        try:
            guard.guarded_sql(views, case.sql)
            rows.append((case.sql, case.expect, False))
        except guard.Refused:
            rows.append((case.sql, case.expect, True))
    return cases.sparkSession.createDataFrame(rows, "Statement string, Expect string, Rejected boolean")


def score_statements(log: DataFrame, cases: DataFrame, views: Star) -> DataFrame:
    """The log (Statement) with what was expected of each statement of the set and what the guard did; each is put once."""
    told = run_statements(cases, views).dropDuplicates(["Statement"])
    return log.join(F.broadcast(told), "Statement").select("Expect", "Rejected")
