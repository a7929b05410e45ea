"""Small JSON files of the driver: settings, registries, parameters."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Mapping
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import SparkSession


def read_json(path: str | Path, default=None):
    """The content of a ``.json`` file; ``default``, if given, where there is none."""
    if Path(path).suffix != ".json":
        raise ValueError(f"{path} isn't a .json file")
    if default is not None and not Path(path).exists():
        return default
    return json.loads(Path(path).read_text(encoding="utf-8"))


def _plain(value):
    if isinstance(value, datetime):
        return value.isoformat()
    return getattr(value, "value", None) or str(value)


def write_json(path: str | Path, content) -> None:
    """Writes a whole file or none: a new file beside it takes its place."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, part = tempfile.mkstemp(dir=path.parent, suffix=".part")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as out:
            json.dump(content, out, ensure_ascii=False, indent=1, default=_plain)
        os.replace(part, path)
    except BaseException:
        Path(part).unlink(missing_ok=True)
        raise


def instant(value: str | datetime | None) -> datetime | None:
    """An ISO date or time in UTC; without a zone it is UTC; None where it can't be read."""
    if isinstance(value, str):
        try:
            value = datetime.fromisoformat(value.strip())
        except ValueError:
            return None
    if value is None:
        return None
    return value.replace(tzinfo=UTC) if value.tzinfo is None else value.astimezone(UTC)


def settings(path: str | Path, env: Mapping[str, str] | None = None, prefix: str = "TRADEWINDS_") -> dict:
    """Settings of a JSON or YAML file; a variable ``PREFIX_SECTION__NAME`` goes before the file's value."""
    text = Path(path).read_text(encoding="utf-8")
    if Path(path).suffix in (".yaml", ".yml"):
        import yaml

        out = yaml.safe_load(text) or {}
    else:
        out = json.loads(text)
    for name, value in sorted((os.environ if env is None else env).items()):
        if name.startswith(prefix):
            *sections, last = name.removeprefix(prefix).split("__")
            at = out
            for section in sections:
                at = at.setdefault(section, {})
            try:
                at[last] = json.loads(value)
            except json.JSONDecodeError:
                at[last] = value
    return out


class Instants:
    """When each key was last handled, in one JSON file: read once, written whole at each mark."""

    def __init__(self, path: str | Path):
        self.path, self.held = Path(path), {k: instant(v) for k, v in read_json(path, {}).items()}

    def get(self, key: str) -> datetime | None:
        return self.held.get(key)

    def mark(self, keys: str | list[str], when: datetime) -> None:
        self.held |= dict.fromkeys([keys] if isinstance(keys, str) else keys, when)
        write_json(self.path, self.held)


class Store:
    """JSON files in any folder that the session's Hadoop can reach, as ``s3a://bucket/folder``."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark._jvm, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def load(self, name: str, default=None):
        """The content of a ``.json`` file; ``default``, if given, where there is none."""
        if Path(name).suffix != ".json":
            raise ValueError(f"{name} isn't a .json file")
        if default is not None and not self._fs.exists(self._path(name)):
            return default
        stream = self._fs.open(self._path(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def save(self, name: str, content) -> None:
        """Writes a whole file or none: a new file beside it takes its place."""
        part, final = self._path(f"{name}.{uuid.uuid4().hex}.part"), self._path(name)
        stream = self._fs.create(part, True)
        stream.write(bytearray(json.dumps(content, ensure_ascii=False, indent=1, default=_plain).encode()))
        stream.close()
        if self._fs.exists(final):
            self._fs.delete(final, False)
        if not self._fs.rename(part, final):
            raise OSError(f"{name} can't be written")
