"""Sets of tables and models that readers see whole or not at all.

A release is written into a folder of its own. Its last step is one small commit
file that names what belongs to it; readers take the newest committed release, so
one that broke off is never seen, and jobs that read an older one keep their files.
"""

import json
import uuid

from trolley.sources.buckets import write_bucketed
from trolley.sources.tables import locate, path_exists, read_table, remove_path, write_table


def _commits(spark, path):
    """Numbers of the committed releases, ascending."""
    if not path_exists(spark, f"{path}/commits"):
        return []
    folder, fs = locate(spark, f"{path}/commits")
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(("_", ".")))


def _write_once(spark, path, text):
    """Put a small file in place in one step; raise if it is there already."""
    temporary, fs = locate(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    target, _ = locate(spark, path)
    out = fs.create(temporary, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(target) or not fs.rename(temporary, target):
        fs.delete(temporary, False)
        raise FileExistsError(f"{path} was written meanwhile")


class NewRelease:
    """A release in the making, committed when its ``with`` block ends without an error."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.number = (_commits(spark, path) or [0])[-1] + 1
        self.folder = f"{path}/releases/{self.number:09d}-{uuid.uuid4().hex}"
        self.content = {"tables": {}, "models": {}}

    def write(self, name, df, key=None, n_buckets=None):
        """Add a table, laid out by the buckets of ``key`` if given; rows are counted from the files' footers."""
        folder = f"{self.folder}/tables/{name}"
        if key is None:
            write_table(df, folder)
        else:
            write_bucketed(df, folder, key, n_buckets)
        rows = self.spark.read.schema(df.schema).parquet(folder).count()
        self.content["tables"][name] = {"path": folder, "rows": rows, "n_buckets": n_buckets}

    def save(self, name, model, save):
        """Add a model by its ``save`` function of (model, path)."""
        save(model, f"{self.folder}/models/{name}")
        self.content["models"][name] = f"{self.folder}/models/{name}"

    def __enter__(self):
        return self

    def __exit__(self, kind, *_):
        if kind is None:
            _write_once(self.spark, f"{self.path}/commits/{self.number:09d}.json", json.dumps(self.content))


class Release:
    """A committed release; ``number`` None takes the newest."""

    def __init__(self, spark, path, number=None):
        known = _commits(spark, path)
        if not known or number not in (None, *known):
            raise FileNotFoundError(f"no release {'' if number is None else number} at {path}")
        self.spark, self.number = spark, known[-1] if number is None else number
        text = spark.read.text(f"{path}/commits/{self.number:09d}.json", wholetext=True).first()[0]
        content = json.loads(text)
        self.tables, self.models = content["tables"], content["models"]

    def table(self, name):
        return read_table(self.spark, self.tables[name]["path"])

    def rows(self):
        """Rows per table, as counted when they were written."""
        return {name: table["rows"] for name, table in self.tables.items()}


def drop_old_releases(spark, path, keep=3):
    """Remove all but the newest releases: their commits first, then the folders no commit names.

    Not to be run while a release is in the making.
    """
    known = _commits(spark, path)
    for number in known[:-keep] if keep else known:
        remove_path(spark, f"{path}/commits/{number:09d}.json")
    named = {f"{number:09d}" for number in known[-keep:]} if keep else set()
    folder, fs = locate(spark, f"{path}/releases")
    for status in fs.listStatus(folder):
        if status.getPath().getName().split("-")[0] not in named:
            fs.delete(status.getPath(), True)
