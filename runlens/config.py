"""Settings of a deployment: which jobs to watch, which tags to keep, where
the tables live. Checked when built, so a load never starts half set up."""

from __future__ import annotations

from dataclasses import dataclass, field

from runlens import schemas


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Settings:
    """``pairs``: (Team, Type) tag values of jobs to watch (compared trimmed
    and case-insensitive). ``targets``: environment -> (catalog, schema);
    ``env`` picks one, default ``prod``; any other value picks ``dev``."""

    pairs: tuple[tuple[str, str], ...]
    targets: dict[str, tuple[str, str]] = field(default_factory=dict)
    env: str = "prod"
    additional_tag_keys: tuple[str, ...] = ()
    excluded: tuple = ()

    def clean_pairs(self) -> list[tuple[str, str]]:
        """Pairs trimmed and upper-cased, duplicates and empty pairs removed;
        at least one must remain."""
        out = sorted({(str(a or "").strip().upper(), str(b or "").strip().upper()) for a, b in self.pairs})
        out = [p for p in out if p[0] and p[1]]
        if not out:
            raise ConfigError("no Team/Type pair configured")
        return out

    def tag_keys(self) -> list[str]:
        return schemas.tag_keys(self.additional_tag_keys)

    def target(self) -> str:
        """``catalog.schema`` for the environment; an empty value is an
        error."""
        env = (self.env or "prod").strip().lower() or "prod"
        key = "prod" if env == "prod" else "dev"
        catalog, schema = self.targets.get(key, ("", ""))
        if not str(catalog).strip() or not str(schema).strip():
            raise ConfigError(f"empty catalog/schema for environment {key!r}")
        return f"{str(catalog).strip()}.{str(schema).strip()}"

    def table(self, name: str) -> str:
        return f"{self.target()}.{name}"
