"""Configuration and fixed values of the canonical contract."""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -------------------------------------------------------------------------------------------
CONTRACT_VERSION = "1.0.0"
ENGINE_VERSION = "0.1.0"
PRECLEAN_VERSION = "0.1.0"
FRONT_MATTER_VERSION = "0.1.0"
CLASSIFY_VERSION = "0.2.0"
PDF_DIAGNOSTICS_VERSION = "0.1.0"
PDF_MEMORY_VERSION = "0.1.0"

BQ_OPEN, BQ_CLOSE = "⟦PRL:BQ⟧", "⟦/PRL:BQ⟧"
FN_OPEN, FN_CLOSE = "⟦PRL:FN⟧", "⟦/PRL:FN⟧"
REF_OPEN, REF_CLOSE = "⟦PRL:REF⟧", "⟦/PRL:REF⟧"
BLOCK_TOKENS = (BQ_OPEN, BQ_CLOSE, FN_OPEN, FN_CLOSE)
ALL_TOKENS = (*BLOCK_TOKENS, REF_OPEN, REF_CLOSE)

NOISE_PATTERNS = (
    r"https?://\S+",
    r"\bwww\.\S+\.\S+",
    r"\[pág\.\s*\d+\]",
    r"\bISBN\b",
    r"\bCDD\b",
    r"\bCDU\b",
    r"Dados Internacionais de Catalogação",
    r"Câmara Brasileira do Livro",
    r"Compre agora e leia",
)
MIN_RUN, FRONT_ZONE = 4, 80
CONCEPTUAL, FORMAL = (750, 1100), (2200, 3500)
FORMATS = {".html": "html", ".htm": "html", ".xhtml": "html", ".epub": "epub", ".txt": "txt", ".text": "txt", "": "txt", ".pdf": "pdf"}


@dataclass(frozen=True)
class Config:
    """One run's settings. Per-document values (format, edition, translation layer) are columns."""

    min_size: int = 1000
    unit: str = "words"
    extra_noise: tuple[str, ...] = ()
    keep_front_matter: bool = False
    min_run: int = MIN_RUN
    front_zone: int = FRONT_ZONE
    target_chars: int | None = None
    max_chars: int | None = None

    def __post_init__(self) -> None:
        if self.unit not in ("words", "chars"):
            raise ValueError(f"unknown unit {self.unit!r}: words or chars")

    @property
    def noise(self) -> tuple[str, ...]:
        return NOISE_PATTERNS + self.extra_noise

    @property
    def front_matter_signature(self) -> str:
        return f"fm:{FRONT_MATTER_VERSION}:run={self.min_run}:zone={self.front_zone}"
