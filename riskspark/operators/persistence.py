"""A4, A5, F1: saving and loading fitted Python models, alone or as stages of a ``pyspark.ml`` pipeline.

A fitted model here is a handful of literals, so its state is JSON inside the metadata file that
every ML writer makes; nothing is pickled, and a loaded model has the saved one's uid and params."""

from __future__ import annotations

import importlib
import json

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter

_STATE = "riskspark_state"


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802  (name of the base class)
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={_STATE: json.dumps(self.instance.state())})


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        module, _, name = metadata["class"].rpartition(".")
        kind = getattr(importlib.import_module(module), name)
        if not issubclass(kind, self.kind):
            raise ValueError(f"{path} holds a {metadata['class']}, not a {self.kind.__name__}")
        instance = kind.from_state(json.loads(metadata[_STATE]))
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance


class SavedAsJson(MLWritable, MLReadable):
    """Mix-in: classes give ``state()`` (JSON values) and ``from_state(state)``."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)
