"""Changes of several stored tables that readers see all at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable
import uuid

from pyspark.sql import DataFrame

from timberline.session import create_small_text, names_in, read_small_text, remove_folder
from timberline.sinks.tables import write_parquet
from timberline.sources.tables import Manifest, Tables


class ConcurrentChange(RuntimeError):
    """Raised when another change was published since this one began; nothing is changed by this one."""


class Change:
    """Folders for a new manifest. Use it in a ``with`` block and end with ``publish``.

    Every write goes to a folder of its own, which no manifest names yet, so a stop between any two
    writes leaves readers the tables as they were. ``publish`` creates the next manifest in one step,
    and refuses if another change has done so meanwhile. Folders of a change that fails are removed.
    The manifest before stays for those who still read by it; older ones and what only they name go.
    """

    def __init__(self, tables: Tables):
        self.target = tables
        self.before = tables.manifest() or Manifest()
        self.tables = {
            name: {key: list(folders) for key, folders in keys.items()} for name, keys in self.before.tables.items()
        }
        self.buckets = self.before.buckets
        self.written: list[str] = []

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            for path in self.written:
                remove_folder(self.target.spark, path)

    def clear(self, *names: str) -> None:
        for name in names:
            self.tables[name] = {}

    def read(self, name: str, folders: Iterable[str] | None = None) -> DataFrame:
        """A table as this change leaves it so far, or those rows that lie in some of its folders."""
        if folders is None:
            folders = [folder for stored in self.tables.get(name, {}).values() for folder in stored]
        return self.target.read_folders(name, [f"{self.target.path(name)}/{folder}" for folder in folders])

    def add(
        self,
        name: str,
        rows: DataFrame,
        key: str | None = None,
        write: Callable[..., int] = write_parquet,
    ) -> int:
        """Writes rows next to those of the table; ``key`` is a column that says which key each belongs to."""
        folder = f"part=p{uuid.uuid4().hex}"
        path = f"{self.target.path(name)}/{folder}"
        self.written.append(path)
        stored = self.tables.setdefault(name, {})
        if key is None:
            count = write(rows, path)
            stored.setdefault("", []).append(folder)
            return count
        count = write(rows, path, by=(key,))
        for inner in names_in(self.target.spark, path):
            if inner.startswith(f"{key}="):
                stored.setdefault(inner.removeprefix(f"{key}="), []).append(f"{folder}/{inner}")
        return count

    def replace(self, name: str, keys: Iterable[str], rows: DataFrame, key: str) -> int:
        """Rows instead of those of some keys; all others stay where they are."""
        for one in map(str, keys):
            self.tables.get(name, {}).pop(one, None)
        return self.add(name, rows, key)

    def publish(self) -> None:
        target, number = self.target, self.before.number + 1
        after = Manifest(number, self.tables, self.buckets)
        if not create_small_text(target.spark, target.manifest_path(number), after.text()):
            raise ConcurrentChange(f"manifest {number} of {target.root} exists already")
        self._clean(after)

    def _clean(self, after: Manifest) -> None:
        """Removes manifests before the last two, and folders that neither of these names."""
        target = self.target
        kept = after.folders() | self.before.folders()
        for number in target.manifest_numbers():
            if number < self.before.number:
                path = target.manifest_path(number)
                old = Manifest.of(read_small_text(target.spark, path))
                for name, folder in old.folders() - kept:
                    remove_folder(target.spark, f"{target.path(name)}/{folder}")
                remove_folder(target.spark, path)
