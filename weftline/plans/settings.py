"""Options of a run. Environment variables override the defaults; the number of slots is capped."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from weftline.sources.fetch import MOST_SLOTS


def _env(name: str, default: str) -> str:
    return os.environ.get(name, default)


@dataclass(frozen=True)
class Settings:
    base_url: str = field(default_factory=lambda: _env("SITE_BASE_URL", "https://site.example"))
    image_base_url: str = field(default_factory=lambda: _env("IMAGE_BASE_URL", "https://images.example"))
    second_base_url: str = field(default_factory=lambda: _env("SECOND_BASE_URL", "https://second.example/"))
    slots: int = field(default_factory=lambda: max(1, min(MOST_SLOTS, int(_env("CONCURRENCY", "3")))))
    pause: tuple[float, float] = field(default_factory=lambda: (float(_env("DELAY_MIN", "1.0")), float(_env("DELAY_MAX", "2.0"))))
    attempts: int = field(default_factory=lambda: int(_env("MAX_ATTEMPTS", "5")))
    backoff: float = field(default_factory=lambda: float(_env("BACKOFF_BASE", "2.0")))
    timeout: float = field(default_factory=lambda: float(_env("HTTP_TIMEOUT", "30")))
    user_agent: str = field(default_factory=lambda: _env("USER_AGENT", "Mozilla/5.0"))
    output_dir: str = field(default_factory=lambda: _env("OUTPUT_DIR", "output"))
    most_pages: int = 500

    @property
    def regions_url(self) -> str:
        return f"{self.base_url}/district_temple_list.php"

    def second_url(self, page: str, tid: int) -> str:
        return f"{self.second_base_url}{page}.php?tid={tid}"
