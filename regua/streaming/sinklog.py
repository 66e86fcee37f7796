"""What a streaming query has committed: its batches, and the files of its file sink.

A query logs a batch twice: the checkpoint's ``commits`` hold the batches that are
done, the sink's own log holds the files of each batch. A crash may fall between
the two; the restarted query then runs the batch again, and the sink leaves out
what it has already. So a batch belongs to the run that commits it in the
checkpoint, and every event is counted by one run, whatever happened before.

The sink packs its log from time to time and drops old entries, so the files known
before a run are kept, and those of the run are the ones known afterwards without
them. The driver holds names of files only, as it does for any table that is read.
"""

from __future__ import annotations

import json
from collections.abc import Collection

from pyspark.sql import Column, SparkSession, functions as F

from regua.sources.tables import names_in, text_of

LOG = "_spark_metadata"
PACKED = ".compact"
#: Levels of folders below the target.
DEPTH = 2


def _batches(spark: SparkSession, folder: str) -> dict[int, str]:
    """Log files by batch, hidden ones left out; the packed form of a batch is preferred."""
    found = {}
    for name in sorted(names_in(spark, folder)):
        number = name.removesuffix(PACKED)
        if number.isdigit():
            found[int(number)] = name
    return found


def last_commit(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that the query of a checkpoint has finished, -1 if none."""
    return max(_batches(spark, f"{checkpoint.rstrip('/')}/commits"), default=-1)


def refuse_foreign(spark: SparkSession, target: str, checkpoint: str) -> None:
    """Refuse a target that another query has written to.

    A sink takes a batch number it knows for a repetition and drops the batch. With the
    checkpoint of another query that would lose events without a word.
    """
    written = max(_batches(spark, f"{target.rstrip('/')}/{LOG}"), default=-1)
    if written <= last_commit(spark, checkpoint):
        return
    if written not in _batches(spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"{target} holds batches of another checkpoint than {checkpoint}")


def committed_files(spark: SparkSession, target: str, upto: int | None = None) -> list[str]:
    """Every file that the sink has committed, in batches up to ``upto``, by its folders and name below the target."""
    folder = f"{target.rstrip('/')}/{LOG}"
    logs = _batches(spark, folder)
    wanted = [b for b in sorted(logs) if upto is None or b <= upto]
    # The last packed log holds all that went before.
    packed = max((b for b in wanted if logs[b].endswith(PACKED)), default=None)
    places = []
    for batch in wanted:
        if packed is None or batch >= packed:
            # The first line is the version of the log.
            for line in text_of(spark, f"{folder}/{logs[batch]}").splitlines()[1:]:
                entry = json.loads(line)
                if entry["action"] == "add":
                    places.append("/".join(entry["path"].split("/")[-DEPTH - 1 :]))
    return places


def files_since(spark: SparkSession, target: str, known: Collection[str]) -> list[str]:
    """Files committed that are not among those known before."""
    known = frozenset(known)
    return [place for place in committed_files(spark, target) if place not in known]


def place_of_row() -> Column:
    """The file that a row was read from, spelled as in ``committed_files``."""
    return F.substring_index(F.col("_metadata.file_path"), "/", -DEPTH - 1)
