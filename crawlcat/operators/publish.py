"""Publication: staged generations, manifests, atomic files, and what the logs say."""

from __future__ import annotations

import fcntl
import hashlib
import json
import os
import shutil
import tempfile
import time
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, functions as F


def manifest_faults(manifest: DataFrame, staged: DataFrame) -> DataFrame:
    """(path, fault) where a staged file (path, sha256) is missing, unexpected or different."""
    m, s = manifest.select("path", F.col("sha256").alias("want")), staged.select("path", F.col("sha256").alias("got"))
    fault = F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "unexpected").when(F.col("want") != F.col("got"), "different")
    return m.join(s, "path", "full_outer").select("path", fault.alias("fault")).where("fault is not null")


def probe_failures(logs: DataFrame, key: str, log: str, marker: str) -> DataFrame:
    """(key, failed): lines of a log that begin with ``marker``."""
    return logs.select(key, F.size(F.filter(F.split(log, "\n"), lambda line: line.startswith(marker))).cast("long").alias("failed"))


def write_atomic(path: Path, data: bytes) -> None:
    """Whole or not at all: a temporary file beside it, synced, then renamed."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.chmod(temporary, 0o644)
        os.replace(temporary, path)
    except BaseException:
        Path(temporary).unlink(missing_ok=True)
        raise


def _taken_over(path: Path, stale: float) -> bool:
    """Whether a lock is gone, or was stale and is gone now; looking and removing are one step among all who wait."""
    with open(path.with_name(f"{path.name}.guard"), "w") as guard:
        fcntl.flock(guard, fcntl.LOCK_EX)
        try:
            if time.time() - path.stat().st_mtime <= stale:
                return False
            path.unlink(missing_ok=True)
        except FileNotFoundError:
            pass
        return True


@contextmanager
def write_lock(path: Path, timeout: float = 120.0, stale: float = 3600.0):
    """An exclusive lock file; one older than ``stale`` seconds is taken over."""
    began = time.monotonic()
    path.parent.mkdir(parents=True, exist_ok=True)
    while True:
        try:
            os.close(os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
            break
        except FileExistsError:
            if _taken_over(path, stale):
                continue
            if time.monotonic() - began > timeout:
                raise TimeoutError(f"{path} is held by another run") from None
            time.sleep(0.05)
    try:
        yield
    finally:
        path.unlink(missing_ok=True)


def stage(root: Path, files: dict[str, bytes]) -> Path:
    """A new generation folder with the files and a manifest of their hashes."""
    folder = root / "generations" / uuid.uuid4().hex
    for name, data in files.items():
        write_atomic(folder / name, data)
    write_atomic(folder / "MANIFEST.json", json.dumps({n: hashlib.sha256(b).hexdigest() for n, b in sorted(files.items())}, indent=2).encode())
    return folder


def verify_staged(folder: Path) -> None:
    manifest = json.loads((folder / "MANIFEST.json").read_text())
    for name, want in manifest.items():
        if not (folder / name).is_file() or hashlib.sha256((folder / name).read_bytes()).hexdigest() != want:
            raise ValueError(f"{name} in {folder} isn't what was staged")


def materialize(root: Path, folder: Path, last: str) -> None:
    """Publish a generation: pointer, files, ``last`` after all others, then the pointer goes."""
    verify_staged(folder)
    pointer = root / "PENDING.json"
    write_atomic(pointer, json.dumps({"generation": folder.name}).encode())
    names = sorted(json.loads((folder / "MANIFEST.json").read_text()), key=lambda n: (n == last, n))
    for name in names:
        write_atomic(root / name, (folder / name).read_bytes())
    pointer.unlink(missing_ok=True)
    shutil.rmtree(folder, ignore_errors=True)


def recover(root: Path, last: str) -> bool:
    """Finish a publication that was broken off; a pointer to nothing is cleared."""
    pointer = root / "PENDING.json"
    if not pointer.exists():
        return False
    try:
        folder = root / "generations" / json.loads(pointer.read_text())["generation"]
        verify_staged(folder)
    except (ValueError, KeyError, OSError):
        pointer.unlink(missing_ok=True)
        return False
    materialize(root, folder, last)
    return True


def publish(root: Path, files: dict[str, bytes], last: str) -> None:
    with write_lock(root / ".lock"):
        recover(root, last)
        materialize(root, stage(root, files), last)
