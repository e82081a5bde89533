"""Settings as plain dataclasses, from a JSON or YAML file and the environment."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from pathlib import Path

PREFIX = "PAPERLOOM_"


@dataclass
class Ocr:
    primary: str = "tesseract"
    fallback: str = "easyocr"
    languages: list[str] = field(default_factory=lambda: ["en"])
    threshold: float = 0.6


@dataclass
class Pdf:
    dpi: int = 300
    page_format: str = "PNG"


@dataclass
class Checks:
    tolerance: float = 0.01
    required: list[str] = field(default_factory=lambda: ["invoice_number", "invoice_date", "final_total"])


@dataclass
class Settings:
    ocr: Ocr = field(default_factory=Ocr)
    pdf: Pdf = field(default_factory=Pdf)
    checks: Checks = field(default_factory=Checks)
    output_dir: str = "output"

    def update(self, values: dict) -> Settings:
        """Takes known keys, leaves others."""
        _update(self, values)
        return self

    def to_dict(self) -> dict:
        return asdict(self)

    def issues(self) -> list[str]:
        out = []
        if not 0 <= self.ocr.threshold <= 1:
            out.append("ocr.threshold lies outside 0 to 1")
        if self.pdf.dpi <= 0:
            out.append("pdf.dpi is not positive")
        if self.pdf.page_format.upper() not in ("PNG", "JPEG", "TIFF"):
            out.append("pdf.page_format is not PNG, JPEG or TIFF")
        if self.checks.tolerance < 0:
            out.append("checks.tolerance is negative")
        return out


def _update(target, values: dict) -> None:
    known = {f.name for f in fields(target)}
    for k, v in values.items():
        if k in known:
            own = getattr(target, k)
            if is_dataclass(own) and isinstance(v, dict):
                _update(own, v)
            else:
                setattr(target, k, type(own)(v) if not isinstance(own, list) else list(v))


def load(path: str | None = None, environ: dict[str, str] | None = None) -> Settings:
    """Defaults, then the file, then variables such as PAPERLOOM_OCR_THRESHOLD."""
    out = Settings()
    if path:
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith((".yaml", ".yml")):
            import yaml

            out.update(yaml.safe_load(text) or {})
        else:
            out.update(json.loads(text))
    for key, value in (os.environ if environ is None else environ).items():
        if key.startswith(PREFIX):
            section, _, name = key.removeprefix(PREFIX).lower().partition("_")
            if name and section in {f.name for f in fields(out)} and is_dataclass(getattr(out, section)):
                out.update({section: {name: value}})
            else:
                out.update({key.removeprefix(PREFIX).lower(): value})
    return out


def save(settings: Settings, path: str) -> None:
    """Writes settings as YAML (.yaml, .yml) or JSON, so that ``load`` gives them back."""
    values = settings.to_dict()
    if path.endswith((".yaml", ".yml")):
        import yaml

        text = yaml.safe_dump(values, sort_keys=False, allow_unicode=True)
    else:
        text = json.dumps(values, indent=2, ensure_ascii=False)
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(text, encoding="utf-8")


def folders(settings: Settings) -> dict[str, str]:
    """The folders of the results below the output folder: paths alone, Spark makes them when it writes."""
    return {name: f"{settings.output_dir.rstrip('/')}/{name}" for name in ("json", "report", "workbooks", "words", "pages", "seals", "failures")}


def summary(settings: Settings) -> str:
    """One line for each setting."""
    lines = []
    for section, value in settings.to_dict().items():
        lines += [f"{section}.{k}: {v}" for k, v in value.items()] if isinstance(value, dict) else [f"{section}: {value}"]
    return "\n".join(lines)
