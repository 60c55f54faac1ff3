"""Pagination as a stream: landed review pages are read while they come in.

For each product and star the state holds which page comes next, whether reading has ended, and
the pages and attempts that came before their turn. Pages may land in any order and over any
number of runs; what has been read by then is what the batch rule reads of all that landed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hazardlens import schemas
from hazardlens.operators.envelopes import read_review_envelopes
from hazardlens.streaming.keyed import BUCKET, BUCKETS, bucketed, state_on_disk

KEYS = ("product_id", "star")
#: Statuses after which a page is asked for again.
RETRIED = ("TOKEN_EXPIRED", "NO_RESPONSE")
_COLUMNS = "product_id string, star string, page int, attempt int, status string, texts array<string>, total_pages int, n_valid int"


class PagesInTurn(StatefulProcessor):
    """Settled pages of each product and star in turn, up to the last one.

    Attempts of a page are numbered from 1. The first that is no retry settles the page; one
    that has failed ends reading, as does a page without valid reviews or the last of the total,
    which are read themselves. Rows that land twice count once.
    """

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.places = handle.getMapState("places", "product_id string, star string", "next int, ended boolean, held string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        landed: dict[tuple, list[Row]] = {}
        for row in rows:
            landed.setdefault(tuple(row[k] for k in KEYS), []).append(row)
        for place, own in landed.items():
            following, ended, held = 1, False, "{}"
            if self.places.containsKey(place):
                following, ended, held = self.places.getValue(place)
            if ended:
                continue
            waiting = json.loads(held)
            for row in own:
                if row["page"] >= following:
                    waiting.setdefault(str(row["page"]), {}).setdefault(str(row["attempt"]), [row[c] for c in self.columns])
            while not ended and (page := self._settled(waiting.get(str(following), {}))) is not None:
                ended = page["status"] != "OK"
                if not ended:
                    yield Row(**page)
                    ended = page["page"] >= page["total_pages"] or page["n_valid"] == 0
                waiting.pop(str(following))
                following += 1
            self.places.updateValue(place, (following, ended, "{}" if ended else json.dumps(waiting)))

    def _settled(self, attempts: dict[str, list]) -> dict | None:
        """The attempt that settles a page, if all before it have landed."""
        number = 1
        while (values := attempts.get(str(number))) is not None:
            page = dict(zip(self.columns, values, strict=True))
            if page["status"] not in RETRIED:
                return page
            number += 1
        return None

    def close(self) -> None:
        pass


def pages_in_turn(parsed: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Of a stream of parsed review pages those that pagination reads, as soon as it is their turn."""
    columns = [c.split()[0] for c in _COLUMNS.split(", ")]
    rows = bucketed(parsed.select(*columns), KEYS, buckets)
    return rows.groupBy(BUCKET).transformWithState(PagesInTurn(columns), _COLUMNS, "Append", "None")


def stream_review_pages(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: str = schemas.REVIEW_PAGES,
    max_files: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Read what has landed in ``source`` (JSON lines of review pages) up to now, append the pages
    whose turn has come to ``target``, stop and return the table. The next run goes on from there."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    parsed = read_review_envelopes(reader.json(source)).withColumn("total_pages", F.col("total_pages").cast("int"))
    with state_on_disk(spark):
        query = (
            pages_in_turn(parsed, buckets)
            .writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(_COLUMNS).parquet(target)
