"""Project configuration: defaults, merging, profiles and checks (inventory F22, G6, H10, H12, H14, H20, H24, H25, H28, K5, K6, U6)."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field

CONVERTERS = ["liteparse", "docling", "datalab", "pandoc", "cascade"]


@dataclass
class LlmConfig:
    model: str = "stub"
    base_url: str = "http://localhost"
    input_price_per_m: float = 0.14
    output_price_per_m: float = 0.28


@dataclass
class ConverterConfig:
    type: str = "liteparse"
    cascade: list[str] = field(default_factory=list)


@dataclass
class ProcessingConfig:
    max_workers: int = 5


@dataclass
class ProjectConfig:
    org: str = "ORG"
    funders: dict[str, str] = field(default_factory=dict)
    doc_types: list[str] = field(default_factory=list)
    headings: dict[str, list[str]] = field(default_factory=dict)
    classification: dict = field(default_factory=dict)
    audit: dict = field(default_factory=dict)
    llm: LlmConfig = field(default_factory=LlmConfig)
    converter: ConverterConfig = field(default_factory=ConverterConfig)
    processing: ProcessingConfig = field(default_factory=ProcessingConfig)


def merged(base: dict, over: dict) -> dict:
    """``base`` with ``over`` put in, mapping by mapping."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load(text: str) -> ProjectConfig:
    """A configuration from YAML; unknown keys are left out; raises with all that is wrong."""
    import yaml

    given = yaml.safe_load(text) or {}
    parts = {"llm": LlmConfig, "converter": ConverterConfig, "processing": ProcessingConfig}
    own = {f.name for f in dataclasses.fields(ProjectConfig)}
    values = {k: v for k, v in given.items() if k in own}
    for name, kind in parts.items():
        known = {f.name for f in dataclasses.fields(kind)}
        values[name] = kind(**{k: v for k, v in (given.get(name) or {}).items() if k in known})
    config = ProjectConfig(**values)
    if wrong := problems(config):
        raise ValueError("; ".join(wrong))
    return config


def problems(c: ProjectConfig) -> list[str]:
    out = []
    if c.converter.type not in CONVERTERS:
        out.append(f"unknown converter {c.converter.type}")
    if c.converter.type == "cascade" and len(c.converter.cascade) < 2:
        out.append("a cascade needs two converters")
    out += [f"unknown converter {x} in the cascade" for x in c.converter.cascade if x not in CONVERTERS or x == "cascade"]
    if not c.llm.base_url.startswith(("http://", "https://")):
        out.append("the model's base_url is no URL")
    if c.processing.max_workers < 1:
        out.append("max_workers must be 1 or more")
    if not isinstance(c.funders, dict):
        out.append("funders must map abbreviations to names")
    return out


#: The stages that web pages go through.
WEBSITE_STAGES = ["clean", "canonicalize", "classify", "rewrite", "prioritize", "ingest"]
#: Fixed value: the name of an organisation that nobody has set.
UNNAMED = "My Organization"


def _mapping(text: str, what: str) -> dict:
    import yaml

    try:
        given = yaml.safe_load(text) or {}
    except yaml.YAMLError as e:
        raise ValueError(f"{what} is no valid YAML: {e}") from e
    if not isinstance(given, dict):
        raise ValueError(f"{what} must be a mapping")
    return given


def denylist(text: str) -> list[str]:
    """The names of a denylist (YAML with ``names``); blank ones are left out, no ``names`` is an empty list."""
    names = _mapping(text, "denylist").get("names", [])
    if not isinstance(names, list):
        raise ValueError(f"denylist: names must be a list, not {type(names).__name__}")
    return [str(n) for n in names if str(n).strip()]


def profile_headings(text: str, funder: str) -> list[str]:
    """The canonical headings of a funder in a profile, in order: the keys below headings, funder, headings."""
    by = _mapping(text, "profile").get("headings")
    if not isinstance(by, dict):
        raise ValueError("profile has no headings")
    own = by.get(funder)
    if not isinstance(own, dict):
        raise ValueError(f"profile has no headings for {funder}; known: {', '.join(sorted(by))}")
    if not isinstance(own.get("headings"), dict) or not own["headings"]:
        raise ValueError(f"profile's headings for {funder} are empty")
    return [str(x) for x in own["headings"]]


def project(profile: str = "", **own) -> ProjectConfig:
    """A new project from a profile's YAML, with what is its own put over it."""
    import yaml

    return load(yaml.safe_dump(merged(_mapping(profile, "profile") if profile else {}, own)))


def from_scan(funders: dict[str, str], types: list[str], source: str = "") -> dict:
    """A first configuration from what a scan has found: funders with their names, types, and the folder."""
    found = {"funders": funders, "doc_types": list(types), "paths": {"raw_archive": source} if source else {}}
    return {"project": {"name": "My Grant Archive"}, "org": {"name": UNNAMED, "abbreviation": "ORG"}} | {k: v for k, v in found.items() if v}


def stages_of(given: str | None, known: list[str] = WEBSITE_STAGES) -> list[str] | None:
    """Stages from a list by commas: None for all of them, no stage for "none"; raises on an unknown one."""
    if given is None:
        return None
    names = [] if given.strip().lower() == "none" else [x.strip() for x in given.split(",") if x.strip()]
    if unknown := [x for x in names if x not in known]:
        raise ValueError(f"unknown stages: {', '.join(unknown)}; known: {', '.join(known)}")
    return names


def prioritizing(defaults: dict, over: dict | None = None) -> dict:
    """Settings of prioritising: ``over`` put into ``defaults``; the rubric's keys are whole numbers."""
    out = merged(defaults, over or {})
    return out | {"rubric": {int(k): v for k, v in out.get("rubric", {}).items()}}


def enabled(converters: list[dict]) -> list[dict]:
    """The converters of a benchmark that are switched on, as they are unless said otherwise."""
    return [c for c in converters if c.get("enabled", True)]


def extensions_of(converters: list) -> set[str]:
    """All suffixes that any of the converters takes."""
    return {e.lower() for c in converters for e in getattr(c, "extensions", ())}


def corpus_spec(text: str, kinds: list[str]) -> dict:
    """The settings of a synthetic corpus; raises with all that is wrong, joined."""
    given = _mapping(text, "spec")
    counts = given.get("counts", {})
    wrong = [] if isinstance(counts, dict) else ["counts must be a mapping"]
    for kind, n in counts.items() if isinstance(counts, dict) else ():
        if kind not in kinds:
            wrong.append(f"unknown kind {kind}")
        if not isinstance(n, int) or n < 0:
            wrong.append(f"the count of {kind} must be a whole number from 0")
    if not given.get("funders"):
        wrong.append("no funders")
    if wrong:
        raise ValueError("; ".join(wrong))
    return given


def health(c: ProjectConfig, org_name: str = UNNAMED) -> list[tuple[str, str, str]]:
    """check, status and message of a project's settings: what is still to be set, and what is wrong."""
    rows = [("config: org.name", "warn", "the organisation has no name yet")] if org_name == UNNAMED else []
    rows.append(("config: funders", "ok", f"{len(c.funders)} funders") if c.funders else ("config: funders", "warn", "no funders, so none is found in documents"))
    rows.append(("config: doc_types", "ok", f"{len(c.doc_types)} types") if c.doc_types else ("config: doc_types", "warn", "no types, so none is found in documents"))
    return rows + [("config", "error", x) for x in problems(c)]
