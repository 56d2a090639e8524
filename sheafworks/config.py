"""Settings of the annotation pipeline, from a YAML file of sections."""

from __future__ import annotations

from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Annotation:
    max_doc_bytes: int = 10 * 1024 * 1024
    max_doc_pages: int = 150
    max_decompress_ratio: float = 20.0
    min_text_chars: int = 200
    max_bytes_in_shard: int = 5 * 1024**3
    top_k_languages: int = 5
    max_heading_len: int = 150
    form_field_min_length: int = 4
    word_2_entity_overlap_threshold: float = 0.8


def load(path: str) -> Annotation:
    """Sections are flattened and names lower-cased; keys that only concern rendering are left aside."""
    import yaml

    flat = {k.lower(): v for section in yaml.safe_load(Path(path).read_text()).values() for k, v in section.items()}
    return Annotation(**{f.name: flat[f.name] for f in fields(Annotation) if flat.get(f.name) is not None})
