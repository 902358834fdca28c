"""Configuration sets: one YAML file for each corpus, with paths and the settings of every stage."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import yaml

from millrace.operators.cleaning import RuleSet

REQUIRED = ("config_set", "scraping", "cleaning", "chunking")

# The settings that hold where nothing else is said.
DEFAULTS = {
    "scraping": {"max_hops": 2, "skip_patterns": []},
    "chunking": {"chunk_size": 1200, "chunk_overlap": 150, "strategy": "smart", "max_header_level": 3},
    "merging": {"indent": 2},
    "questions": {"num_chunks": 50, "questions_per_chunk": 3, "random_seed": 42},
}


@dataclass
class ConfigSet:
    """A loaded set; ``root`` is the project's folder, against which relative paths count."""

    name: str
    folder: Path
    root: Path
    data: dict = field(default_factory=dict)

    def __post_init__(self):
        if missing := [k for k in REQUIRED if k not in self.data]:
            raise ValueError(f"config set {self.name!r} lacks {', '.join(missing)}")

    def _given(self, key: str, default: str | None = None) -> str | None:
        return (self.data.get("paths") or {}).get(key) or default

    def substituted(self, path: str) -> str:
        """``{config_set_name}``, then ``{data_dir}``."""
        named = lambda x: str(x).replace("{config_set_name}", self.name)
        return named(path).replace("{data_dir}", named(self._given("data_dir", f"data/{self.name}")))

    def resolved(self, path: str, in_folder: bool = False) -> Path:
        """Absolute paths as they are; others against the project, or against the set's own folder."""
        found = Path(self.substituted(path))
        return found if found.is_absolute() else ((self.folder if in_folder else self.root) / found).resolve()

    @property
    def data_dir(self) -> Path:
        return self.resolved("{data_dir}")

    @property
    def state_dir(self) -> Path:
        return self.resolved(self._given("state_dir", "{data_dir}"))

    @property
    def urls_file(self) -> Path:
        return self.resolved(self._given("urls_file", "urls.txt"), in_folder=True)

    @property
    def scrapes_dir(self) -> Path:
        return self.resolved(self._given("scrapes_dir", "{data_dir}/scrapes"))

    @property
    def cleaned_dir(self) -> Path:
        return self.resolved(self._given("cleaned_dir", "{data_dir}/cleaned"))

    @property
    def chunks_dir(self) -> Path:
        return self.resolved(self._given("chunks_dir", "{data_dir}/chunks"))

    @property
    def merged_file(self) -> Path:
        return self.resolved(self._given("merged_file", "{data_dir}/merged.json"))

    def section(self, name: str, **given) -> dict:
        """Settings of a section: what is given (not None), then the set's, then the defaults."""
        return DEFAULTS.get(name, {}) | (self.data.get(name) or {}) | {k: v for k, v in given.items() if v is not None}

    def rule_set(self) -> RuleSet:
        return RuleSet.of(self.data["cleaning"] or {})


def list_config_sets(root: str | Path, base: str = "config") -> list[str]:
    folder = Path(root) / base
    return sorted(p.parent.name for p in folder.glob("*/config.yaml")) if folder.is_dir() else []


def load_config_set(name: str, root: str | Path, base: str = "config") -> ConfigSet:
    """``<root>/<base>/<name>/config.yaml``; the error names the sets that there are."""
    folder = Path(root) / base / name
    if not (folder / "config.yaml").is_file():
        raise FileNotFoundError(f"no config set {name!r}; there are: {', '.join(list_config_sets(root, base)) or 'none'}")
    return ConfigSet(name, folder, Path(root), yaml.safe_load((folder / "config.yaml").read_text(encoding="utf-8")) or {})


def load_rule_set(path: str | Path) -> RuleSet:
    return RuleSet.of(yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})
