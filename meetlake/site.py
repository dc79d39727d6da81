"""The site whose captures are read. All host names derive from one setting."""

from __future__ import annotations

from dataclasses import dataclass

# Host prefixes in the order they are tried; "" is the main domain.
HOST_PREFIXES = ("", "adcc", "ibjjf", "uaejjf", "ajp", "sjjif", "newbreed", "grappling")

# Countries of a full run.
TARGET_COUNTRIES = ("AR", "BR", "CL", "MX", "EC", "VE", "PE", "CO")


@dataclass(frozen=True)
class Site:
    """`domain` is the platform's registered domain, without a host prefix."""

    domain: str = "example.com"
    prefixes: tuple[str, ...] = HOST_PREFIXES

    @property
    def base_url(self) -> str:
        return f"https://{self.domain}"

    @property
    def hosts(self) -> tuple[str, ...]:
        """Candidate hosts, best first."""
        return tuple(f"{p}.{self.domain}" if p else self.domain for p in self.prefixes)

    @property
    def own_token(self) -> str:
        """Text that marks a link as the site's own (the domain without its suffix)."""
        return self.domain.rsplit(".", 1)[0]
