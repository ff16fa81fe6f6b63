"""Fitted preparation and models applied to streaming frames.

Everything ``apply_*`` does is map-side (projections) or a stream-static
join with a small fitted table (category map, label map), so the same
fitted objects score a ``readStream`` frame without state.  The sink writes
to a file path with a checkpoint location on the shared file system, so a
restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tabloom.operators.encode import Preprocess, apply_preprocess
from tabloom.operators.scale import FeatureParams, apply_features
from tabloom.operators.train import Classifier, predict


def prepare_stream(stream: DataFrame, prep: Preprocess | None = None,
                   features: FeatureParams | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Apply fitted imputation/encoding and feature scaling to a stream."""
    out = stream
    if prep is not None:
        out = apply_preprocess(out, prep)
    if features is not None:
        out = apply_features(out, features, keep=keep)
    return out


def score_stream(stream: DataFrame, clf: Classifier, prep: Preprocess | None = None,
                 features: FeatureParams | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Prepared stream with the model's ``prediction`` column."""
    prepared = prepare_stream(stream, prep, features, keep)
    scored = predict(clf, prepared)
    return scored.select(*keep, "prediction")


def write_stream(scored: DataFrame, path: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Append scored rows as Parquet; ``available_now`` processes what is
    there and stops (batch-like catch-up), otherwise runs continuously."""
    w = (scored.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
