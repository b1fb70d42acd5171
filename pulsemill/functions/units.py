"""Units: everything is in cm, ns, eV, electrons and kelvin. Multiply to store, divide to show."""

PREFIXES = {"f": 1e-15, "p": 1e-12, "n": 1e-9, "u": 1e-6, "m": 1e-3, "c": 1e-2, "": 1.0, "k": 1e3, "M": 1e6, "G": 1e9, "T": 1e12}

# Base units.
cm = ns = eV = electron_charge = kelvin = 1.0
m, s, C = 1e2 * cm, 1e9 * ns, electron_charge / 1.602176634e-19
J = eV / 1.602176634e-19
# Derived units.
kg = J * s**2 / m**2
N, W, A, V, Hz = J / m, J / s, C / s, J / C, 1 / s
Ohm, Pa, bar = V / A, J / m**3, 1e5 * J / m**3
boltzmann = 1.380649e-23 * J / kelvin

_SYMBOLS = {"m": m, "s": s, "eV": eV, "g": 1e-3 * kg, "V": V, "A": A, "Hz": Hz, "J": J, "Ohm": Ohm, "bar": bar, "N": N, "W": W, "Pa": Pa, "C": C, "K": kelvin}


def unit(name: str) -> float:
    """Value of a symbol with an optional prefix, as 'kV' or 'us'. Looked up, never evaluated."""
    if name in _SYMBOLS:
        return _SYMBOLS[name]
    if name[:1] in PREFIXES and name[1:] in _SYMBOLS:
        return PREFIXES[name[0]] * _SYMBOLS[name[1:]]
    raise ValueError(f"unknown unit {name!r}")


def quantity(text: str) -> float:
    """A number, with units multiplied or divided: '1.5 * kV / cm'."""
    value, sign = 1.0, 1
    for i, word in enumerate(text.replace("*", " * ").replace("/", " / ").split()):
        if word in "*/":
            sign = 1 if word == "*" else -1
            continue
        try:
            v = float(word)
        except ValueError:
            v = unit(word)
        value, sign = value * v**sign, 1
    return value
