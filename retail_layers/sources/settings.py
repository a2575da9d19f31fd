"""Settings: plain nested mappings, one section per environment."""

from __future__ import annotations

from collections.abc import Mapping


def for_environment(settings: Mapping, env: str) -> Mapping:
    """The section of one environment, or an error that names what is missing."""
    if "environments" not in settings:
        raise ValueError("settings need a top-level 'environments'")
    section = settings["environments"].get(env)
    if section is None:
        raise ValueError(f"no environment {env!r} in settings")
    return section


def required(section: Mapping, key: str, where: str):
    if section.get(key) is None:
        raise ValueError(f"{key!r} missing in {where}")
    return section[key]
