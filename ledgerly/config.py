"""The data contract and the settings, with overrides from a file and the environment."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import os
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

# The contract's columns, catalogues, synonyms, formats and hash tokens.
COLUMNS = ("id_cliente", "date", "product", "type", "fund", "amount", "description", "commercial_name")
PRODUCTS = ("Acciones", "Bonos", "CDT", "Cuenta de Ahorro", "Divisas", "ETF", "Fondo de Inversión", "Fondo de Pensión")
FUNDS = ("Balanceado", "Conservador", "Crecimiento", "Internacional", "Mercado Monetario", "Renta Fija", "Renta Variable")
SYNONYMS = {"IN": ("entrada", "in"), "OUT": ("salida", "out")}
DATE_FORMATS = ((r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"))
SEPARATOR, NULL_TOKEN, HASH_VERSION = "\x1f", "\x1eNULL", "v1"


class ConfigError(ValueError):
    """A setting that the engine can't honour."""


@dataclass(frozen=True)
class Contract:
    """What a snapshot must look like and how its rows get their identity."""

    version: str = "1"
    products: tuple[str, ...] = PRODUCTS
    funds: tuple[str, ...] = FUNDS
    synonyms: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(SYNONYMS))
    date_formats: tuple[tuple[str, str], ...] = DATE_FORMATS
    id_pattern: str = "^CLI[0-9]{6}$"
    business_key: tuple[str, ...] = ("id_cliente", "date", "product", "type", "fund")
    mutable: tuple[str, ...] = ("amount", "description", "commercial_name")
    separator: str = SEPARATOR
    null_token: str = NULL_TOKEN
    hash_version: str = HASH_VERSION
    precision: int = 20
    scale: int = 2
    #: Physical families a required column may have.
    families: dict[str, tuple[str, ...]] = field(default_factory=lambda: {c: ("string",) for c in COLUMNS if c != "amount"} | {"amount": ("number", "string")})

    @property
    def amount_type(self) -> str:
        return f"decimal({self.precision},{self.scale})"

    @property
    def digest(self) -> str:
        """SHA-256 of the contract's text; each run records it."""
        return hashlib.sha256(json.dumps(dataclasses.asdict(self), sort_keys=True, ensure_ascii=False).encode()).hexdigest()


@dataclass(frozen=True)
class Limit:
    warn: float
    fail: float


@dataclass(frozen=True)
class Settings:
    """How runs behave."""

    contract: Contract = field(default_factory=Contract)
    file_glob: str = "*.parquet"
    date_resolution: tuple[str, ...] = ("cli", "filename_iso", "declared_sequence", "max_content_date")
    declared_sequence: dict[str, tuple[str, int]] = field(default_factory=dict)
    same_name_new_hash: str = "reprocess"  # or reject
    known_hash: str = "skip"  # or force
    allow_out_of_order: bool = False
    null_amount_policy: str = "quarantine"  # or keep_with_warning
    rejection_rate: Limit = Limit(0.02, 0.15)
    guards: bool = True
    on_breach: str = "fail"  # or warn_only
    ratio_rows: int = 100
    deleted: Limit = Limit(0.10, 0.30)
    volume_drop: Limit = Limit(0.10, 0.30)
    amount_variation: Limit = Limit(0.20, 0.50)
    min_valid_rows: int = 1
    allow_reactivation: bool = True
    retention_days: int | None = None
    outlier_method: str = "iqr"  # iqr or none
    iqr_multiplier: float = 3.0
    new_category_alert: bool = True
    volume_zscore: float = 3.0
    deletion_share: float = 0.10

    def __post_init__(self) -> None:
        for name, allowed in (("same_name_new_hash", ("reprocess", "reject")), ("known_hash", ("skip", "force")), ("null_amount_policy", ("quarantine", "keep_with_warning")), ("on_breach", ("fail", "warn_only")), ("outlier_method", ("iqr", "none"))):
            if getattr(self, name) not in allowed:
                raise ConfigError(f"{name} must be one of {', '.join(allowed)}")
        if unknown := set(self.contract.business_key) - set(COLUMNS):
            raise ConfigError(f"unknown key columns: {', '.join(sorted(unknown))}")

    @property
    def rejects_null_amount(self) -> bool:
        return self.null_amount_policy == "quarantine"


def _plain(text: str) -> Any:
    """A value from an environment variable."""
    known = {"true": True, "false": False, "null": None, "none": None, "": None}
    if text.lower() in known:
        return known[text.lower()]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def _merge(base: Any, path: list[str], value: Any) -> Any:
    name, *rest = path
    if name not in {f.name for f in dataclasses.fields(base)}:
        raise ConfigError(f"unknown setting: {name}")
    old = getattr(base, name)
    if rest:
        return replace(base, **{name: _merge(old, rest, value)})
    if isinstance(value, dict) and dataclasses.is_dataclass(old):
        for k, v in value.items():
            old = _merge(old, [k], v)
        value = old
    elif isinstance(value, list):
        value = tuple(tuple(x) if isinstance(x, list) else x for x in value)
    return replace(base, **{name: value})


def load(path: str | None = None, prefix: str = "LEDGERLY__", environ: dict[str, str] | None = None) -> Settings:
    """Defaults, then a YAML or JSON file, then variables like LEDGERLY__DELETED__FAIL=0.4."""
    out = Settings()
    if path:
        text = Path(path).read_text(encoding="utf-8")
        if path.endswith(".json"):
            given = json.loads(text)
        else:
            import yaml

            given = yaml.safe_load(text) or {}
        for name, value in given.items():
            out = _merge(out, [name], value)
    for name, value in sorted((os.environ if environ is None else environ).items()):
        if name.startswith(prefix):
            out = _merge(out, name[len(prefix) :].lower().split("__"), _plain(value))
    return out
