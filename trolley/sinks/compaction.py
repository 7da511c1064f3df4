"""Small landed files gathered into large ones, without a reader seeing a row twice or missing one."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from trolley.sinks.files import Commits, remove, size_of

_NAMES = T.ArrayType(T.StringType())
_STATE = T.StructType(
    [
        T.StructField("large", _NAMES),  # gathered files that hold
        T.StructField("hidden", _NAMES),  # landed files that gathered ones stand for
        T.StructField("replaced", _NAMES),  # files that this commit replaced; the next one removes them
    ]
)


@dataclass(frozen=True)
class LandedFiles:
    """A folder that a stream lands files in, and what was gathered from it beside it.

    ``compact`` packs files below half of ``target_bytes`` into files of up to that size: each task
    reads the files of one bin and writes one file, and nothing is shuffled. The new files count
    from the moment of one commit that also hides the old ones. These stay until the next compaction,
    for readers that have listed them. Whoever reads has to read through ``read``. The stream may go on landing files; one compaction runs at a time.

    ``by`` names the columns that the folder is partitioned by, ``options`` how its files are read
    and written. Files that a failed batch left are
    not read, since the log of the streaming sink does not have them.
    """

    path: str
    schema: T.StructType
    kind: str = "parquet"
    by: tuple[str, ...] = ()
    target_bytes: int = 128 << 20
    options: Mapping[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession) -> DataFrame:
        """All landed rows."""
        _, state = self._commits().latest(spark)
        if state is None:
            return self._reader(spark, self.path).load(self.path)
        small = self._landed(spark, set(state.hidden))
        parts = [
            self._reader(spark, folder).load(files)
            for folder, files in [(self.path, small), *self._by_folder(state.large)]
            if files
        ]
        if not parts:
            return spark.createDataFrame([], self.schema)
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows

    def files(self, spark: SparkSession) -> list[str]:
        """The files that ``read`` reads."""
        _, state = self._commits().latest(spark)
        hidden, large = (set(), []) if state is None else (set(state.hidden), state.large)
        return [*self._landed(spark, hidden), *large]

    def compact(self, spark: SparkSession) -> int:
        """Gather small files; returns how many are replaced."""
        number, state = self._commits().latest(spark)
        hidden, large = (set(), []) if state is None else (set(state.hidden), state.large)
        listed = self._listed(spark, self.path)
        sizes = {name: size_of(spark, name) for name in [*(n for n in listed if n not in hidden), *large]}
        chosen = gathered({name: n for name, n in sizes.items() if 2 * n < self.target_bytes}, self.target_bytes)
        if not chosen:
            return 0
        folder = f"{self._home()}/files/{number + 1}"
        self._rewrite(spark, chosen, folder)
        replaced = set(chosen)
        kept = [name for name in large if name not in replaced]
        # the log of a stream goes on listing files that were removed
        hidden = [name for name in listed if name in hidden or name in replaced]
        row = ([*kept, *self._listed(spark, folder)], hidden, chosen)
        self._commits().publish(spark, number + 1, row)
        if state is not None:
            remove(spark, state.replaced)
        return len(chosen)

    def _rewrite(self, spark: SparkSession, chosen: list[str], folder: str) -> None:
        """One file for each bin that Spark packs the chosen files into, largest first."""
        beside = [(self.path, [n for n in chosen if not self._is_ours(n)]), *self._by_folder(filter(self._is_ours, chosen))]
        mode = "overwrite"  # of a compaction that did not get to its commit
        with _packing(spark, self.target_bytes):
            for root, files in beside:
                if files:
                    rows = self._reader(spark, root).load(files)
                    writer = rows.write.mode(mode).format(self.kind).options(**self.options)
                    writer = writer.partitionBy(*self.by) if self.by else writer
                    writer.save(folder)
                    mode = "append"

    def _landed(self, spark: SparkSession, hidden: set[str]) -> list[str]:
        return [name for name in self._listed(spark, self.path) if name not in hidden]

    def _listed(self, spark: SparkSession, folder: str) -> list[str]:
        """Files of a folder, by the log of the stream where there is one."""
        return [unquote(name) for name in self._reader(spark, folder).load(folder).inputFiles()]

    def _reader(self, spark: SparkSession, root: str):
        return spark.read.format(self.kind).schema(self.schema).options(**self.options).option("basePath", root)

    def _home(self) -> str:
        return f"{self.path.rstrip('/')}.compacted"

    def _is_ours(self, name: str) -> bool:
        return f"{self._home().rsplit('/', 1)[-1]}/files/" in name

    def _by_folder(self, files) -> list[tuple[str, list[str]]]:
        """Gathered files by the compaction that made them."""
        folders: dict[str, list[str]] = {}
        for name in files:
            head, tail = name.split(f"{self._home().rsplit('/', 1)[-1]}/files/", 1)
            number = tail.split("/", 1)[0]
            folders.setdefault(f"{self._home()}/files/{number}", []).append(name)
        return list(folders.items())

    def _commits(self) -> Commits:
        return Commits(f"{self._home()}/commits", _STATE)


def gathered(sizes: dict[str, int], target: int) -> list[str]:
    """Files worth gathering: those that share a bin with another one, by first fit of the largest."""
    bins: list[tuple[int, list[str]]] = []
    open_bins: list[int] = []
    for name, size in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        for at in open_bins:
            held, names = bins[at]
            if held + size <= target:
                bins[at] = (held + size, [*names, name])
                break
        else:
            open_bins.append(len(bins))
            bins.append((size, [name]))
        open_bins = [at for at in open_bins if bins[at][0] + 1 <= target]
    return [name for _, names in bins if len(names) > 1 for name in names]


@contextmanager
def _packing(spark: SparkSession, target: int) -> Iterator[None]:
    """Scans planned inside this fill their tasks with whole files of ``target`` bytes together."""
    wanted = {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": "1",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
