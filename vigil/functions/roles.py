"""Column roles and name cleaning.

The raw sensor table uses display names with brackets and spaces; inside the
library every column is addressed by a snake_case role.  ``RAW_TO_ROLE`` maps
the raw names onto the roles (applied once at load time by ``rename_cols``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Raw column names of the sensor table and their roles.
RAW_TO_ROLE = {
    "UDI": "key",
    "UID": "key",
    "Product ID": "product_id",
    "Type": "type",
    "Air temperature [K]": "air_temp",
    "Process temperature [K]": "proc_temp",
    "Rotational speed [rpm]": "speed",
    "Torque [Nm]": "torque",
    "Tool wear [min]": "wear",
    "Machine failure": "failure",
    "TWF": "twf",
    "HDF": "hdf",
    "PWF": "pwf",
    "OSF": "osf",
    "RNF": "rnf",
}

SENSORS = ["air_temp", "proc_temp", "speed", "torque", "wear"]
MODES = ["twf", "hdf", "pwf", "osf", "rnf"]
# Type levels of the sensor table (fixed values).
TYPE_LEVELS = ["H", "L", "M"]


@dataclass(frozen=True)
class Roles:
    air_temp: str = "air_temp"
    proc_temp: str = "proc_temp"
    speed: str = "speed"
    torque: str = "torque"
    wear: str = "wear"
    type: str = "type"
    target: str = "failure"
    key: str = "key"
    ts: str = "ts"
    machine: str = "machine_id"
    modes: tuple = field(default=tuple(MODES))

    @property
    def sensors(self) -> list[str]:
        return [self.air_temp, self.proc_temp, self.speed, self.torque, self.wear]


DEFAULT = Roles()


def clean_name(name: str, sep: str = "", op: str = "") -> str:
    """Display name -> identifier: drop brackets, spaces become underscores."""
    base = name.replace("[", "").replace("]", "").replace(" ", "_")
    return f"{base}{sep}{op}" if op else base
