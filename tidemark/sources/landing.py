"""Files on their way to the landing layer: archives, manifests, byte-exact emission, verified copies. Driver side."""

from __future__ import annotations

import os
import re
import shutil
import zipfile
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path


class LandingRefused(ValueError):
    """A file that is not what it should be; nothing has been left behind."""


#: File groups of the registry source: prefix and number of parts, none for a single file. (fixed values)
FILE_GROUPS = {"empresas": ("Empresas", 10), "estabelecimentos": ("Estabelecimentos", 10), "socios": ("Socios", 10), "lookups": (("Cnaes", "Motivos", "Municipios", "Naturezas", "Paises", "Qualificacoes"), None)}


def expected_files(groups: Iterable[str]) -> list[str]:
    """Archive names of the groups."""
    names: list[str] = []
    for g in groups:
        if g not in FILE_GROUPS:
            raise LandingRefused(f"unknown file group {g!r}")
        prefix, parts = FILE_GROUPS[g]
        names += [f"{p}.zip" for p in prefix] if parts is None else [f"{prefix}{i}.zip" for i in range(parts)]
    return names


def missing_files(listed: Iterable[str], groups: Iterable[str]) -> list[str]:
    """Expected archives that a listing lacks."""
    there = set(listed)
    return [n for n in expected_files(groups) if n not in there]


def unzip_single(archive: Path, into: Path) -> Path:
    """Extracts the one file of an archive, whole or not at all; one already there with the same size is kept."""
    try:
        with zipfile.ZipFile(archive) as z:
            members = [m for m in z.infolist() if not m.is_dir()]
            if len(members) != 1:
                raise LandingRefused(f"{archive.name} holds {len(members)} files")
            member = members[0]
            if member.header_offset < 0:
                raise LandingRefused(f"{archive.name} is cut off")
            target = into / Path(member.filename).name
            if target.exists() and target.stat().st_size == member.file_size:
                return target
            part = target.with_name(target.name + ".part")
            with z.open(member) as src, part.open("wb") as dst:
                shutil.copyfileobj(src, dst, 1 << 20)
            if part.stat().st_size != member.file_size:
                part.unlink()
                raise LandingRefused(f"{archive.name}: short extraction")
            os.replace(part, target)
            return target
    except zipfile.BadZipFile as e:
        raise LandingRefused(f"{archive.name} is no archive: {e}") from e


def unzip_dir(archives: Path, into: Path) -> list[Path]:
    """Extracts every archive of a directory, in order."""
    into.mkdir(parents=True, exist_ok=True)
    return [unzip_single(a, into) for a in sorted(archives.glob("*.zip"))]


@dataclass(frozen=True)
class Emitted:
    path: Path
    size: int
    written: bool


def emit_file(lines: Iterable[str], path: Path) -> Emitted:
    """Writes lines ending in a bare newline, reads them back, then puts the file in place.

    The same bytes already there are left alone; other bytes are refused, never replaced.
    """
    part = path.with_name(path.name + ".part")
    path.parent.mkdir(parents=True, exist_ok=True)
    with part.open("wb") as f:
        for line in lines:
            if "\n" in line or "\r" in line:
                part.unlink()
                raise LandingRefused("a record spans lines")
            f.write(line.encode() + b"\n")
    size = part.stat().st_size
    if path.exists():
        same = path.stat().st_size == size and all(a == b for a, b in zip(_blocks(path), _blocks(part), strict=True))
        part.unlink()
        if not same:
            raise LandingRefused(f"{path} holds other bytes")
        return Emitted(path, size, False)
    os.replace(part, path)
    return Emitted(path, size, True)


def _blocks(path: Path):
    with path.open("rb") as f:
        while block := f.read(1 << 20):
            yield block


def copy_verified(source: Path, target: Path) -> int:
    """Copies a file and compares lengths; a short copy is removed and refused."""
    target.parent.mkdir(parents=True, exist_ok=True)
    shutil.copyfile(source, target)
    if target.stat().st_size != source.stat().st_size:
        target.unlink(missing_ok=True)
        raise LandingRefused(f"{target}: short copy")
    return target.stat().st_size


def safe_name(name: str) -> str:
    """A single path component; anything else is refused."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name):
        raise LandingRefused(f"not a file name: {name!r}")
    return name
