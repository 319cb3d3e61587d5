"""Named sources and sinks, and checks that a plugin must pass."""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession


@runtime_checkable
class Source(Protocol):
    def read(self, spark: SparkSession) -> DataFrame: ...
    def describe(self) -> dict: ...


@runtime_checkable
class StreamSource(Source, Protocol):
    """A source that also gives a stream; ``folder`` is where a bounded one keeps what it replays."""

    def read_stream(self, spark: SparkSession, folder: str) -> DataFrame: ...


@runtime_checkable
class Sink(Protocol):
    def write(self, df: DataFrame) -> None: ...
    def describe(self) -> dict: ...


@runtime_checkable
class StreamSink(Sink, Protocol):
    """A sink that also takes a stream, batch by batch under the batch's name."""

    def write_batch(self, df: DataFrame, batch: str) -> None: ...
    def write_stream(self, df: DataFrame, checkpoint: str) -> None: ...


_KNOWN: dict[str, type] = {}


def connector(name: str):
    """Register a source or sink class under a name."""

    def add(cls: type) -> type:
        if not (hasattr(cls, "read") or hasattr(cls, "write")):
            raise TypeError(f"{cls.__name__} is neither a source nor a sink")
        if name in _KNOWN:
            raise ValueError(f"the name {name!r} is taken by {_KNOWN[name].__name__}")
        _KNOWN[name] = cls
        return cls

    return add


def build(name: str, **config):
    if name not in _KNOWN:
        raise KeyError(f"unknown connector {name!r}; available: {', '.join(sorted(_KNOWN))}")
    return _KNOWN[name](**config)


def available() -> dict[str, str]:
    return {n: "source" if hasattr(c, "read") else "sink" for n, c in sorted(_KNOWN.items())}


def check_registered(name: str) -> None:
    assert name in _KNOWN, f"{name} is not registered"


def check_source(source, spark: SparkSession) -> DataFrame:
    df = source.read(spark)
    assert isinstance(df, DataFrame), "read() gives a DataFrame"
    assert {"group_id", "channel", "ts_ms", "value"} <= set(df.columns), "read() gives long points"
    assert isinstance(source.describe(), dict), "describe() gives a dict"
    return df


def check_sink(sink, df: DataFrame) -> None:
    sink.write(df)
    assert isinstance(sink.describe(), dict), "describe() gives a dict"
