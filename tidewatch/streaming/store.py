"""Tables fed batch by batch, made visible by a manifest and kept compact.

A batch writes a folder per table and then one manifest: a small file that lists the
live folders of all tables. It is renamed into place, so readers see all of a batch or
nothing, and a folder without a manifest is never read. Folders of one level
are merged into one of the next when there are ``FAN`` of them, so their number, and with it the
cost of reading, grows with the logarithm of the number of batches. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

FAN = 8

Merge = Callable[[DataFrame], DataFrame]
Derived = Callable[[Callable[[str], DataFrame]], DataFrame]


def _same(rows: DataFrame) -> DataFrame:
    return rows


@dataclass(frozen=True)
class BatchStore:
    """The tables below a folder. ``merges`` says how rows of several batches of a table become those of one."""

    spark: SparkSession
    path: str
    merges: Mapping[str, Merge]

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _versions(self) -> list[int]:
        fs, folder = self._fs(f"{self.path}/manifest")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self) -> dict:
        """The latest manifest: the last batch, and per table its schema and its live folders with their levels."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "batch": -1, "tables": {}}
        fs, at = self._fs(f"{self.path}/manifest/{versions[-1]}.json")
        stream = fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        target = f"{self.path}/manifest/{manifest['version']}.json"
        fs, draft = self._fs(f"{target}.{uuid.uuid4().hex}.draft")
        stream = fs.create(draft)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        if not fs.rename(draft, self._fs(target)[1]):
            raise RuntimeError(f"{target} is there already: another writer is at work")

    def commit(self, batch: int, tables: Mapping[str, DataFrame | Derived]) -> None:
        """Store the rows of a batch in all of the tables; a batch that is in the manifest already is left as it is.

        Tables are written in the given order. One that is computed from those before is given as a function: it
        gets a function from a table's name to the rows of this batch, read back from what was just written.
        """
        old = self.manifest()
        if batch <= old["batch"]:
            return
        new = {"version": old["version"] + 1, "batch": batch, "tables": dict(old["tables"])}

        def written(name: str) -> DataFrame:
            return self._read(new["tables"][name], [f"{name}/batch-{batch}"])

        for name, rows in tables.items():
            rows = rows(written) if callable(rows) else rows
            new["tables"][name] = self._added(new["tables"].get(name), name, rows, f"{name}/batch-{batch}", 0)
        self._publish(new)
        self._compact()

    def _added(self, table: dict | None, name: str, rows: DataFrame, folder: str, level: int) -> dict:
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")
        table = table or {"schema": rows.schema.jsonValue(), "live": []}
        return {**table, "live": [*table["live"], [folder, level]]}

    def _compact(self) -> None:
        """Merge full levels, one manifest a merge; the folders merged stay for readers that have an older manifest."""
        while True:
            old = self.manifest()
            full = next(((name, level) for name, table in old["tables"].items() for level in {x for _, x in table["live"]}
                         if sum(x == level for _, x in table["live"]) >= FAN), None)
            if full is None:
                return
            name, level = full
            table = old["tables"][name]
            merged = [folder for folder, x in table["live"] if x == level]
            rows = self.merges.get(name, _same)(self._read(table, merged))
            kept = {**table, "live": [[folder, x] for folder, x in table["live"] if x != level]}
            folder = f"{name}/merged-{old['version'] + 1}"
            tables = {**old["tables"], name: self._added(kept, name, rows, folder, level + 1)}
            self._publish({"version": old["version"] + 1, "batch": old["batch"], "tables": tables})

    def _read(self, table: dict, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(table["schema"])).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, name: str) -> DataFrame:
        """All rows of a table as of the latest manifest; rows of several batches are not merged here."""
        table = self.manifest()["tables"][name]
        return self._read(table, [folder for folder, _ in table["live"]])

    def merged(self, name: str) -> DataFrame:
        """The table as if it had come in one batch."""
        return self.merges.get(name, _same)(self.read(name))

    def vacuum(self, keep: int = 1) -> int:
        """Delete manifests but the last ``keep`` and the folders that none of these lists; returns the folders deleted.

        Only while nothing reads older manifests and no batch is being written.
        """
        versions = self._versions()
        used, tables = set(), set()
        for v in versions[-keep:]:
            fs, at = self._fs(f"{self.path}/manifest/{v}.json")
            stream = fs.open(at)
            listed = json.loads(bytes(stream.readAllBytes()).decode())["tables"]
            stream.close()
            tables |= set(listed)
            used |= {folder for table in listed.values() for folder, _ in table["live"]}
        for v in versions[:-keep]:
            fs, at = self._fs(f"{self.path}/manifest/{v}.json")
            fs.delete(at, False)
        dropped = 0
        for name in tables:
            fs, at = self._fs(f"{self.path}/{name}")
            for status in fs.listStatus(at):
                if f"{name}/{status.getPath().getName()}" not in used:
                    fs.delete(status.getPath(), True)
                    dropped += 1
        return dropped
