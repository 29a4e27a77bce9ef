"""Settings, passed explicitly so that executors get them by value."""

from __future__ import annotations

import os
from dataclasses import dataclass, replace

from lexloom.errors import ConfigurationError


@dataclass(frozen=True)
class Config:
    input_folder: str = "workspace/input"
    archive_folder: str = "workspace/archive"
    results_folder: str = "workspace/results"
    additional_folder: str = "workspace/additional"
    dictionary_folder: str | None = None  # of base forms, a file for each language
    text_files: bool = True  # a run also writes its texts as one file each, in order
    debug_sample_size: int = 20
    primary_language: str = "ru"
    use_v_as_russian_marker: bool = True
    word_healer_enabled: bool = True
    word_healer_passes: int = 5
    word_healer_exceptions_file: str | None = None
    pdf_x_tolerance: int = 3
    pdf_y_tolerance: int = 3
    pdf_adaptive_tolerance: bool = True
    pdf_badness_threshold: float = 0.3
    pdf_layout_mode: bool = True

    def validate(self) -> Config:
        """Itself, or ConfigurationError naming every setting that is out of range."""
        wrong = []
        if self.debug_sample_size < 0:
            wrong.append("debug_sample_size must not be negative")
        if self.word_healer_passes < 1:
            wrong.append("word_healer_passes must be at least 1")
        if self.pdf_x_tolerance < 0 or self.pdf_y_tolerance < 0:
            wrong.append("PDF tolerances must not be negative")
        if not 0 <= self.pdf_badness_threshold <= 1:
            wrong.append("pdf_badness_threshold must be between 0 and 1")
        if self.word_healer_exceptions_file and os.path.isdir(self.word_healer_exceptions_file):
            wrong.append("word_healer_exceptions_file must not be a folder")
        if wrong:
            raise ConfigurationError("; ".join(wrong))
        return self

    def with_(self, **changes) -> Config:
        return replace(self, **changes)


DEFAULT = Config()
