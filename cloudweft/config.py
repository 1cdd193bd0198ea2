"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping

from cloudweft.errors import ConfigError


def require_env(*names: str, source: Mapping[str, str] | None = None) -> dict[str, str]:
    """The values of all names; an empty value counts as absent. Names all that are absent at once."""
    values = os.environ if source is None else source
    absent = [name for name in names if not values.get(name)]
    if absent:
        raise ConfigError(f"missing settings: {', '.join(absent)}")
    return {name: values[name] for name in names}
