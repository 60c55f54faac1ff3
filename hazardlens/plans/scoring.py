"""Scoring batches with a function the user supplies.

Only the texts of a batch cross to Python, as one Arrow value per batch; keys and
positions stay in the JVM.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.constants import (
    MAX_ATTEMPTS,
    PASS1_BATCH,
    PASS2_BATCH,
)

Scorer = Callable[[list[str]], list[int]]
Model = Callable[[str], str | None]


@dataclass(frozen=True)
class ScorerConfig:
    """How a pass is cut into calls. Whole texts are sent unless ``max_chars`` cuts them.

    A task calls the scorer for about ``batches_per_task`` batches, whatever the bytes of their
    texts, so tasks follow the data; ``tasks`` is how many may call it at most, where the model has
    a limit. Labels are saved after about ``batches_per_commit`` batches each. ``version`` names the
    scorer in a cache of scores.
    """

    name: str
    batch_size: int
    max_chars: int | None = None
    attempts: int = MAX_ATTEMPTS
    wait_seconds: float = 0.0
    tasks: int | None = None
    batches_per_task: int = 16
    batches_per_commit: int = 10_000
    version: str = "1"

    def tasks_for(self, batches: int) -> int:
        needed = max(1, -(-batches // self.batches_per_task))
        return needed if self.tasks is None else min(needed, self.tasks)


FIRST_PASS = ScorerConfig("first_pass", PASS1_BATCH)
SECOND_PASS = ScorerConfig("second_pass", PASS2_BATCH)


def labels_of(texts: Column, make_scorer: Callable[[], Scorer], config: ScorerConfig) -> Column:
    """``labels`` of each text list and the ``error`` of the last attempt, one of them NULL."""
    attempts, wait = config.attempts, config.wait_seconds

    @F.pandas_udf("labels array<int>, error string")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()

        def one(batch):
            for attempt in range(attempts):
                try:
                    return [None if v is None else int(v) for v in scorer(list(batch))], None
                except Exception as failure:
                    error = f"{type(failure).__name__}: {failure}"
                    if attempt + 1 < attempts:
                        time.sleep(wait)
            return None, error

        for series in batches:
            answers = [one(batch) for batch in series]
            yield pd.DataFrame(
                {
                    "labels": pd.Series([a for a, _ in answers], dtype=object),
                    "error": pd.Series([e for _, e in answers], dtype=object),
                }
            )

    return score.asNondeterministic()(texts)


def score_batches(
    batches: DataFrame,
    make_scorer: Callable[[], Scorer],
    config: ScorerConfig = FIRST_PASS,
    count: int | None = None,
) -> DataFrame:
    """Gathered batches with ``labels`` and ``error``; ``zip_labels`` turns labels into rows.

    Batches are spread by their keys over as many tasks as ``config`` says for their ``count``,
    which is found out if it is not given: calls are slow, however few bytes their texts have.
    """
    keys = [c for c in batches.columns if c != "items"]
    spread = batches.repartition(config.tasks_for(batches.count() if count is None else count), *keys)
    texts = F.transform("items", lambda item: item["text"])
    answer = labels_of(texts, make_scorer, config)
    return spread.withColumn("_answer", answer).select("*", "_answer.*").drop("_answer")


def ask_batches(
    prompts: DataFrame, make_model: Callable[[], Model], config: ScorerConfig = FIRST_PASS
) -> DataFrame:
    """Batch prompts with the ``response`` of a text model and the ``error`` of the last attempt.

    A response that holds no JSON counts as a failed attempt; it is NULL when
    every attempt failed.
    """
    attempts, wait = config.attempts, config.wait_seconds
    around = re.compile(r"\A\s*(`{3}(json)?)?|(`{3})?\s*\Z")

    @F.pandas_udf("response string, error string")
    def ask(series_list: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_model()

        def one(prompt):
            for attempt in range(attempts):
                try:
                    response = model(prompt)
                    if response is not None:
                        json.loads(around.sub("", response))
                    return response, None if response is not None else "no response"
                except Exception as failure:
                    error = f"{type(failure).__name__}: {failure}"
                    if attempt + 1 < attempts:
                        time.sleep(wait)
            return None, error

        for series in series_list:
            answers = [one(prompt) for prompt in series]
            yield pd.DataFrame(
                {
                    "response": pd.Series([r for r, _ in answers], dtype=object),
                    "error": pd.Series([e for _, e in answers], dtype=object),
                }
            )

    keys = [c for c in prompts.columns if c != "prompt"]
    spread = prompts.repartition(config.tasks_for(prompts.count()), *keys)
    answered = spread.withColumn("_answer", ask.asNondeterministic()("prompt"))
    return answered.select("*", "_answer.*").drop("_answer")
