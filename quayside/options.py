"""Settings of every step, with their defaults. ``from_properties`` reads the connector-style property names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# Names and defaults that stored configurations rely on.
INSTITUTION_HEADER = "X-Institution-Id"
EVENT_TYPE_HEADER = "X-Event-Type"
VERSION_HEADER = "X-Event-Version"
SOURCE_FIELD = "encryptedPrimaryAccountNumber"
TARGET_FIELD = "primaryAccountNumber"
STRATEGIES = ("REMOVE", "MASK", "DECRYPT", "REKEY", "NONE", "TOKENIZE")
CRYPTO_STRATEGIES = ("DECRYPT", "REKEY", "TOKENIZE")
ACTIONS = ("ENCRYPT", "SKIP")
HOUR_FORMAT = "'year'=YYYY/'month'=MM/'day'=dd/'hour'=HH"
PATH_DEFAULTS = {INSTITUTION_HEADER: "UNKNOWN", EVENT_TYPE_HEADER: "UNCLASSIFIED", VERSION_HEADER: "v0"}


def csv_names(text: str | None) -> tuple[str, ...]:
    """Names of a comma list: trimmed, blanks and repeats dropped, order kept."""
    return tuple(dict.fromkeys(name.strip() for name in (text or "").split(",") if name.strip()))


def truth(value) -> bool:
    return value if isinstance(value, bool) else str(value).strip().lower() == "true"


def strategy_name(text: str) -> str:
    name = text.strip().upper()
    if name not in STRATEGIES:
        raise ValueError(f"unknown strategy: {text}")
    return name


@dataclass(frozen=True)
class HeaderNames:
    institution: str = INSTITUTION_HEADER
    event_type: str = EVENT_TYPE_HEADER
    version: str = VERSION_HEADER


@dataclass(frozen=True)
class ProtectOptions:
    rules: str = ""
    default_strategy: str = "REMOVE"
    strategy: str | None = None  # older single-strategy setting, overrides the default
    source_field: str = SOURCE_FIELD
    target_field: str = TARGET_FIELD
    names: HeaderNames = field(default_factory=HeaderNames)
    mask_character: str = "*"
    mask_prefix: int = 6
    mask_suffix: int = 4
    private_key: str | None = None

    def __post_init__(self):
        chosen = self.strategy or self.default_strategy
        object.__setattr__(self, "default_strategy", strategy_name(chosen))
        object.__setattr__(self, "mask_character", self.mask_character[0])

    @classmethod
    def from_properties(cls, props: Mapping[str, str]) -> ProtectOptions:
        names = HeaderNames(
            props.get("institution.id.header", INSTITUTION_HEADER),
            props.get("event.type.header", EVENT_TYPE_HEADER),
            props.get("version.header", VERSION_HEADER),
        )
        return cls(
            rules=props.get("rules", ""),
            default_strategy=props.get("default.strategy", "REMOVE"),
            strategy=props.get("strategy") or None,
            source_field=props.get("source.field", SOURCE_FIELD),
            target_field=props.get("target.field", TARGET_FIELD),
            names=names,
            mask_character=props.get("mask.character", "*"),
            mask_prefix=int(props.get("mask.prefix.digits", 6)),
            mask_suffix=int(props.get("mask.suffix.digits", 4)),
            private_key=props.get("private.key.path") or None,
        )


@dataclass(frozen=True)
class FoldOptions:
    mandatory: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    target_field: str = "headers"
    fail_on_missing: bool = True
    wrap: bool = False
    payload_field: str = "payload"

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.mandatory + self.optional))

    @classmethod
    def from_properties(cls, props: Mapping[str, str]) -> FoldOptions:
        return cls(
            mandatory=csv_names(props.get("mandatory.headers")),
            optional=csv_names(props.get("optional.headers")),
            target_field=props.get("target.field", "headers"),
            fail_on_missing=truth(props.get("fail.on.missing.mandatory", True)),
            wrap=truth(props.get("wrap.payload", False)),
            payload_field=props.get("payload.field", "payload"),
        )


@dataclass(frozen=True)
class LayoutOptions:
    fields: tuple[str, ...] = ()
    labelled: bool = True
    path_format: str = HOUR_FORMAT
    duration_ms: int = 3_600_000
    zone: str = "UTC"
    delimiter: str = "/"
    defaults: tuple[tuple[str, str], ...] = ()  # (field, value) used instead of an error when the field is null

    def with_defaults(self) -> LayoutOptions:
        """Fill missing institution, type and version by the documented placeholders."""
        filled = tuple(
            (name, value) for name in self.fields for header, value in PATH_DEFAULTS.items()
            if name.rsplit(".", 1)[-1] == header
        )
        return replace(self, defaults=filled)

    @classmethod
    def from_properties(cls, props: Mapping[str, str]) -> LayoutOptions:
        return cls(
            fields=csv_names(props.get("partition.field.name")),
            labelled=truth(props.get("partition.field.format.path", True)),
            path_format=props.get("path.format", HOUR_FORMAT),
            duration_ms=int(props.get("partition.duration.ms", 3_600_000)),
            zone=props.get("timezone", "UTC"),
        )


@dataclass(frozen=True)
class FileOptions:
    flush_size: int = 1_000
    rotate_ms: int | None = None
    # Whether a file's time starts with its first record; otherwise files end at fixed buckets of record time.
    rotate_exact: bool = False
    pad: int = 10
    # Offsets of one topic partition ranked in one task. Offsets are unique there, so this bounds every group.
    chunk_offsets: int = 1 << 20
    # Bytes of lines handled together; a file of many frames is never held whole.
    frame_bytes: int = 1 << 20

    @classmethod
    def from_properties(cls, props: Mapping[str, str]) -> FileOptions:
        rotate = props.get("rotate.interval.ms")
        return cls(
            flush_size=int(props.get("flush.size", 1_000)), rotate_ms=int(rotate) if rotate else None,
            rotate_exact=bool(rotate),
            pad=int(props.get("filename.offset.zero.pad.width", 10)),
        )


@dataclass(frozen=True)
class SealOptions:
    names: HeaderNames = field(default_factory=HeaderNames)
    compress: bool = True
    plain_suffix: str = ".json"
    sealed_suffix: str = ".json.pgp"

    @classmethod
    def from_properties(cls, props: Mapping[str, str], prefix: str = "") -> SealOptions:
        """Header names of a sealing transform, or of the encrypting file format under its ``prefix``."""
        return cls(names=HeaderNames(
            props.get(f"{prefix}institution.header", INSTITUTION_HEADER),
            props.get(f"{prefix}event.type.header", EVENT_TYPE_HEADER),
            props.get(f"{prefix}event.version.header", VERSION_HEADER),
        ))
