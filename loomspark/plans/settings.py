"""Settings: files of overrides over typed defaults, and what follows from them."""

from __future__ import annotations

import json
from dataclasses import asdict, fields
from typing import Any, TypeVar

T = TypeVar("T")


def read_settings(path: str) -> dict[str, Any]:
    """The mapping in a JSON file, or in a YAML file where a YAML reader is installed. Any other root is an error."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as missing:
            raise ValueError("no YAML reader is installed; write the settings as JSON") from missing
        found = yaml.safe_load(text)
    else:
        found = json.loads(text) if text.strip() else None
    if found is None:
        return {}
    if not isinstance(found, dict):
        raise ValueError(f"settings must be a mapping: {path}")
    return found


def overridden(base: T, overrides: dict[str, Any] | None, section: str) -> T:
    """The defaults with overrides; the class checks the values again. A key that it lacks is an error."""
    if not isinstance(overrides, dict | None):
        raise ValueError(f"{section} must be a mapping")
    if unknown := sorted((overrides or {}).keys() - {f.name for f in fields(base)}):
        raise ValueError(f"unknown keys in {section}: {', '.join(unknown)}")
    return type(base)(**(asdict(base) | (overrides or {})))


def given(**arguments: Any) -> dict[str, Any]:
    """Arguments that were given, as overrides: those that aren't None."""
    return {k: v for k, v in arguments.items() if v is not None}


#: Columns of a training batch by what uses them; fixed names, in their order.
BATCH_COLUMNS = (
    ("always", ("text_ids", "text_mask", "num_frames")),
    ("caption", ("caption_ids", "caption_mask", "has_caption")),
    ("speaker", ("ref_latent_patched", "ref_latent_mask_patched", "has_speaker")),
    ("latent", ("latent_patched", "latent_mask_patched", "latent_mask_valid_patched")),
    ("duration", ("duration_features",)),
)


def batch_columns(caption: bool = False, speaker: bool = False, latent: bool = True, duration: bool = False) -> tuple[str, ...]:
    """Columns that an objective reads; all others are pruned from the scan."""
    used = {"always": True, "caption": caption, "speaker": speaker, "latent": latent, "duration": duration}
    return tuple(c for use, columns in BATCH_COLUMNS for c in columns if used[use])
