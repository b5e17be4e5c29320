"""Image discovery (S15) and the detection job.

The detector is a user-supplied callable ``detect(image_bytes) -> list[(class_name, score)]``
loaded once per task; Spark reads the files (``binaryFile``), partitions them and
streams Arrow batches through ``mapInPandas``. ``detections`` gives every image a row: what was found, or the ``fault`` that
the detector raised. ``detect_images`` keeps the sound ones. ``detect_new_images`` is the same job as a
stream over the folder: its checkpoint knows the files that are done, so a later run takes only new ones, and
its file sink commits each batch once. A detector that can't be loaded at all fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import params
from ..functions.calendar import to_utc_ntz
from ..sources.schemas import RAW_DETECTION

IMAGE_FILE = "path string, modificationTime timestamp, length long, content binary"  # rows of binaryFile
Detector = Callable[[bytes], Sequence[tuple[str, float]]]


def image_files(spark: SparkSession, root: str, extensions: Sequence[str] = params.IMAGE_EXTENSIONS) -> DataFrame:
    """All image files under ``root`` (recursive), by extension in lower or upper case."""
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", _glob(extensions))
            .load(root))


def _glob(extensions: Sequence[str]) -> str:
    return "*.{" + ",".join(sorted({e.lower() for e in extensions} | {e.upper() for e in extensions})) + "}"


def stub_detector(data: bytes) -> list[tuple[str, float]]:
    """Deterministic stand-in detector (no model weights ship with this library): derives
    classes from the image bytes so tests can check the job end to end."""
    if not data or data[:1] == b"\x00":
        raise ValueError("unreadable image")
    vocab = ["person", "bottle", "cup", "vase", "car", "dog", "cell phone"]
    h = sum(data) % 97
    n = h % 4
    return [(vocab[(h + i) % len(vocab)], round(0.2 + ((h + 7 * i) % 80) / 100.0, 3)) for i in range(n)]


def _detect_batches(detector_factory: Callable[[], Detector], threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detector = detector_factory()  # once per task/worker, not per row
        for pdf in batches:
            paths, objs, scores, times, faults = [], [], [], [], []
            for path, content, mtime in zip(pdf["path"], pdf["content"], pdf["modificationTime"]):
                fault = None
                try:
                    found = [(c, float(s)) for c, s in detector(bytes(content)) if float(s) > threshold]
                except Exception as e:  # noqa: BLE001 - any fault of a user's detector belongs to its image
                    found, fault = [], f"{type(e).__name__}: {e}"
                paths.append(path)
                objs.append([c for c, _ in found])
                scores.append([s for _, s in found])
                times.append(mtime)
                faults.append(fault)
            yield pd.DataFrame({"image_path": pd.Series(paths, dtype="object"),
                                "detected_objects": pd.Series(objs, dtype="object"),
                                "confidence_scores": pd.Series(scores, dtype="object"),
                                "detection_time": pd.to_datetime(pd.Series(times)),
                                "fault": pd.Series(faults, dtype="object")})
    return run


WITH_FAULT = T.StructType([*RAW_DETECTION.fields, T.StructField("fault", T.StringType())])


def detections(files: DataFrame, detector_factory: Callable[[], Detector] = lambda: stub_detector,
               threshold: float = params.DETECTION_THRESHOLD) -> DataFrame:
    """binaryFile rows (batch or stream) -> ``RAW_DETECTION`` and ``fault``, a row for every image; classes with score above
    ``threshold`` are kept. ``detection_time`` is the file's modification time."""
    tz = files.sparkSession.conf.get("spark.sql.session.timeZone")
    src = files.select("path", "content", to_utc_ntz(F.col("modificationTime"), tz).alias("modificationTime"))
    return src.mapInPandas(_detect_batches(detector_factory, threshold), WITH_FAULT)


def detect_images(files: DataFrame, detector_factory: Callable[[], Detector] = lambda: stub_detector,
                  threshold: float = params.DETECTION_THRESHOLD) -> DataFrame:
    """The detections of the images that the detector could read (schema ``RAW_DETECTION``)."""
    return detections(files, detector_factory, threshold).filter("fault IS NULL").drop("fault")


def detect_new_images(spark: SparkSession, root: str, target: str, checkpoint: str,
                      detector_factory: Callable[[], Detector] = lambda: stub_detector,
                      threshold: float = params.DETECTION_THRESHOLD, images_per_batch: int = 10_000,
                      extensions: Sequence[str] = params.IMAGE_EXTENSIONS) -> StreamingQuery:
    """Detect on the images below ``root`` that no earlier run over ``checkpoint`` has seen, into the Parquet folder
    ``target`` (``WITH_FAULT``: filter on ``fault`` for detections or for the error table). Runs over what is there."""
    files = (spark.readStream.schema(IMAGE_FILE).format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", _glob(extensions)).option("maxFilesPerTrigger", images_per_batch).load(root))
    return (detections(files, detector_factory, threshold).writeStream.format("parquet").outputMode("append")
            .option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def argmax_class(scores: Column, classes: Column, threshold: float = params.DETECTION_THRESHOLD) -> Column:
    """X4 on score vectors: the class with the highest score when it exceeds the threshold."""
    best = F.array_max(scores)
    idx = F.array_position(scores, best)
    return F.when(best > threshold, F.element_at(classes, idx.cast("int")))
