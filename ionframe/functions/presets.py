"""Named search presets.

FIXED VALUES from the reference's search parameter files: fixed and variable
modification masses, maximum modifications, precursor tolerance, isotope
error range, number of tolerable termini and matches per spectrum. Every
operator takes these as ordinary arguments; a preset is only a default set.
"""

from __future__ import annotations

from dataclasses import dataclass, field

CARBAMIDOMETHYL = 57.021465
OXIDATION = 15.994915
PHOSPHO = 79.966331
TMT6 = 229.1629
TMT16 = 304.207146
DEAMIDATION = 0.984016
UBIQ_GG = 114.0429


@dataclass(frozen=True)
class Preset:
    name: str
    fixed: dict = field(default_factory=dict)        # residue ('<' = N-term) -> delta mass
    variable: tuple = ()                              # (residues, delta mass)
    max_mods: int = 3
    tol_ppm: float = 20.0
    isotopes: tuple = (-1, 0, 1, 2)
    ntt: int = 2
    matches: int = 1
    length: tuple = (6, 50)
    charges: tuple = (2, 3, 4, 5)


_C = {"C": CARBAMIDOMETHYL}
PRESETS = {p.name: p for p in [
    Preset("pr-lf", dict(_C), (("M", OXIDATION),), 3, 20.0, (-1, 0, 1), 1, 1),
    Preset("pr-tmt11", dict(_C, K=TMT6, **{"<": TMT6}), (("M", OXIDATION),), 3, 20.0, (-1, 0, 1, 2), 1, 1),
    Preset("pr-tmt16", dict(_C, K=TMT16, **{"<": TMT16}), (("M", OXIDATION),), 3, 20.0, (-1, 0, 1, 2), 1, 1),
    Preset("ph-lf", dict(_C), (("STY", PHOSPHO),), 3, 20.0, (-1, 0, 1, 2), 2, 2),
    Preset("ph-tmt11", dict(_C, K=TMT6, **{"<": TMT6}), (("STY", PHOSPHO),), 3, 20.0, (-1, 0, 1, 2), 2, 1),
    Preset("ph-tmt16", dict(_C, K=TMT16, **{"<": TMT16}), (("STY", PHOSPHO),), 3, 20.0, (-1, 0, 1, 2), 2, 1),
    Preset("ac-tmt11", dict(_C, K=TMT6, **{"<": TMT6}),
           (("M", OXIDATION), ("K", -187.15234), ("K", -186.157086), ("N", DEAMIDATION)), 4, 20.0, (0, 1), 2, 1),
    Preset("ac-tmt16", dict(_C, K=TMT16, **{"<": TMT16}),
           (("M", OXIDATION), ("K", -262.196586), ("K", -261.201332), ("N", DEAMIDATION)), 4, 20.0, (0, 1), 2, 1),
    Preset("ub-tmt11", dict(_C, K=TMT6, **{"<": TMT6}),
           (("M", OXIDATION), ("K", UBIQ_GG), ("K", -115.12)), 3, 20.0, (-1, 0, 1), 1, 1),
    Preset("ub-lf", {"K": TMT6, "<": TMT6}, (("M", OXIDATION), ("K", UBIQ_GG), ("K", 343.2058)), 3, 20.0,
           (-1, 0, 1, 2), 1, 1),
    Preset("ub-tmt16", dict(_C, K=TMT16, **{"<": TMT16}),
           (("M", OXIDATION), ("K", UBIQ_GG), ("K", 418.25008)), 3, 20.0, (-1, 0, 1, 2), 1, 1),
    Preset("first-pass", dict(_C, K=TMT16, **{"<": TMT16}), (), 0, 50.0, (-1, 0, 1, 2), 2, 1),
    Preset("first-pass-lf", dict(_C), (), 0, 50.0, (-1, 0, 1, 2), 2, 1),
    Preset("first-pass-tmt11", dict(_C, K=TMT6, **{"<": TMT6}), (), 0, 50.0, (-1, 0, 1, 2), 2, 1),
    Preset("first-pass-ph-tmt16", dict(_C, K=TMT16, S=PHOSPHO, **{"<": TMT16}), (("TY", PHOSPHO),), 3, 50.0, (-1, 0, 1, 2), 2, 1),
    Preset("first-pass-ph-tmt11", dict(_C, K=TMT6, S=PHOSPHO, **{"<": TMT6}), (("TY", PHOSPHO),), 3, 50.0, (-1, 0, 1, 2), 2, 1),
]}
PRESETS["pr-tmt18"] = PRESETS["pr-tmt16"]
PRESETS["ph-tmt18"] = PRESETS["ph-tmt16"]
PRESETS["ac-tmt18"] = PRESETS["ac-tmt16"]
PRESETS["ub-tmt18"] = PRESETS["ub-tmt16"]
# without a tag, lysine forms weigh what they add to bare lysine: acetyl and carbamyl
ACETYL, CARBAMYL = 42.010565, 43.005814
PRESETS["ac-lf"] = Preset("ac-lf", dict(_C), (("M", OXIDATION), ("K", ACETYL), ("K", CARBAMYL), ("N", DEAMIDATION)), 4, 20.0, (0, 1), 2, 1)
