"""Named channel settings: JSON files of label, laser and colour per wavelength, kept in one folder."""

from __future__ import annotations

import argparse
import json
import os
import shutil
from pathlib import Path

from voxloom.sources.metafiles import checked_settings

#: Setting that is there before any is added.
DEFAULT = {
    "405": {"label": "blue", "laser_wavelength": "405", "color": "0000FF"},
    "488": {"label": "green", "laser_wavelength": "488", "color": "00FF00"},
    "561": {"label": "red", "laser_wavelength": "561", "color": "FF0000"},
    "640": {"label": "far red", "laser_wavelength": "640", "color": "FF00FF"},
}


def folder(path: str | None = None) -> Path:
    """The settings folder: given, or named by VOXLOOM_SETTINGS, or below the home folder; made with a default setting if it is new."""
    at = Path(path or os.environ.get("VOXLOOM_SETTINGS") or Path.home() / ".voxloom")
    at.mkdir(parents=True, exist_ok=True)
    if not (first := at / "channels_default.json").exists():
        first.write_text(json.dumps(DEFAULT, indent=2))
    return at


def names(path: str | None = None) -> list[str]:
    return sorted(p.stem.removeprefix("channels_") for p in folder(path).glob("channels_*.json"))


def find(name: str = "default", path: str | None = None) -> Path:
    """A settings file: by its own path, or the only one whose name holds the keyword."""
    if Path(name).is_file():
        return Path(name)
    hits = [n for n in names(path) if name in n]
    if len(hits) != 1:
        raise FileNotFoundError(f"{len(hits)} channel settings for '{name}'")
    return folder(path) / f"channels_{hits[0]}.json"


def load(name: str = "default", path: str | None = None) -> dict:
    return checked_settings(find(name, path).read_text())


def add(file: str, name: str = "default", path: str | None = None) -> Path:
    """Check a JSON file and keep a copy under a name."""
    checked_settings(Path(file).read_text())
    to = folder(path) / f"channels_{name}.json"
    shutil.copy(file, to)
    return to


def main(args: list[str] | None = None) -> int:
    """add FILE [NAME], list, show NAME."""
    p = argparse.ArgumentParser(prog="python -m voxloom.settings", description=main.__doc__)
    p.add_argument("--folder")
    sub = p.add_subparsers(dest="what", required=True)
    a = sub.add_parser("add")
    a.add_argument("file")
    a.add_argument("name", nargs="?", default="default")
    sub.add_parser("list")
    sub.add_parser("show").add_argument("name")
    o = p.parse_args(args)
    if o.what == "add":
        print(add(o.file, o.name, o.folder))
    elif o.what == "list":
        print("\n".join(names(o.folder)))
    else:
        for k, v in load(o.name, o.folder).items():
            print(f"{k}: {v['label']}, laser {v['laser_wavelength']}, colour {v['color']}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
