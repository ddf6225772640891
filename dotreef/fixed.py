"""Codes, labels and spellings that results depend on. Not logic, not tunable."""

from __future__ import annotations

# --- fixed values: codes -------------------------------------------------------------------
UNKNOWN_CODE = 1
OLD_INVERTEBRATE_CODE = 2
INVERTEBRATE_CODE = 99900044
THALASSODENDRON_CODE = 63618905
ECKLONIA_CODE = 54079009
MISTYPED_CODE = 90300910
CORRECT_CODE = 80300910

# --- fixed values: spellings in the exports ------------------------------------------------
UNKNOWN_LABELS = ("Unknown", "Open Water")
INVERTEBRATE_COMPLEX = "Invertebrate Complex"
SESSILE_INVERTEBRATES = "Sessile invertebrates"
MATRIX_LABEL = "Bryozoa / Cnidaria Matrix"
THALASSODENDRON = "Thalassodendrum sp."
THALASSODENDRON_EPIPHYTES = "Thalassodendrum sp. with epiphytes algae"
ECKLONIA = "Ecklonia radiata"
DRIFT_ALGAE = "Drift Algae"
BAD_IMAGE = "IO333.jpg"

# --- fixed values: top labels that stand one level too high in compound exports --------------
BIOTA_GROUPS = ("Bryozoa", "Cnidaria", "Macroalgae", "Seagrasses", "Sponges")
SUBSTRATE_GROUP = "Substrate"

# --- fixed values: expected dots -------------------------------------------------------------
POINTS_STANDARD = 20
POINTS_DENSE = 40
POINTS_DROP_CAMERA = 80

# --- fixed values: label repairs (target, condition, new value), first match per target ------
LABEL_FIXES = [
    ("level_2", {"level_2": ["Invertebrate Complex"], "level_3": ["Complex 1"]}, "Sessile invertebrates"),
    ("level_3", {"level_2": ["Sessile invertebrates"]}, None),
    ("level_3", {"level_2": ["Macroalgae"], "level_3": ["Drift"]}, None),
    ("level_3", {"level_3": ["Erect course branching"]}, "Erect coarse branching"),
    ("level_4", {"level_2": ["Consolidated"], "level_4": ["Turf mat", "Veneer"]}, None),
]

# --- fixed values: species written into a level (level, label, family, genus, species) -------
SPECIES_IN_LEVELS = [
    ("level_5", "Ecklonia radiata", "Lessoniaceae", "Ecklonia", "radiata"),
    ("level_5", "Scytothalia dorycarpa", "Seirococcaceae", "Scytothalia", "dorycarpa"),
    ("level_4", "Posidonia sp. (Caab 63600903)", "Posidoniaceae", "Posidonia", "spp"),
    ("level_4", "Zostera sp. (Caab 63600903)", "Zosteraceae", "Zostera", "spp"),
]

# --- fixed values: labels that replace the annotator's, by code (levels 1 to 5) --------------
LABELS_BY_CODE = [
    (82001003, "Physical", "Substrate", "Consolidated (hard)", "Boulders", None),
    (82001004, "Physical", "Substrate", "Consolidated (hard)", "Cobbles", None),
    (82001002, "Physical", "Substrate", "Consolidated (hard)", "Rock", None),
    (82001007, "Physical", "Substrate", "Unconsolidated (soft)", "Pebble / gravel", "Biologenic"),
    (82001011, "Physical", "Substrate", "Unconsolidated (soft)", "Pebble / gravel", "Gravel (2-10mm)"),
    (82001012, "Physical", "Substrate", "Unconsolidated (soft)", "Pebble / gravel", "Pebble (10-64mm)"),
    (82001014, "Physical", "Substrate", "Unconsolidated (soft)", "Sand / mud (<2mm)", "Coarse sand (with shell fragments)"),
    (82001015, "Physical", "Substrate", "Unconsolidated (soft)", "Sand / mud (<2mm)", "Fine sand (no shell fragments)"),
    (11168902, None, "Cnidaria", "Corals", "Black & Octocorals", "Branching (3D)"),
    (11168912, None, "Cnidaria", "Corals", "Black & Octocorals", "Fan (2D)"),
    (11001000, None, "Cnidaria", "Hydroids", None, None),
    (10000909, None, "Sponges", "Cup-likes", None, None),
    (11168917, None, "Cnidaria", "Corals", "Black & Octocorals", "Whip"),
    (11168918, None, "Cnidaria", "Corals", "Black & Octocorals", "Quill (seapen)"),
    (80300930, None, None, "Filamentous / filiform", None, None),
]

# --- fixed values: count-matrix columns -> labels / codes ------------------------------------
BIOTA_LEVEL_2 = {
    "biota_macroalgae": "Macroalgae",
    "biota_seagrasses": "Seagrasses",
    "biota_sponges": "Sponges",
    "biota_cnidaria": "Cnidaria",
    "biota_crustacea": "Crustacea",
    "biota_echinoderms": "Echinoderms",
    "biota_fishes": "Fishes",
    "biota_molluscs": "Molluscs",
    "biota_worms": "Worms",
    "biota_bryozoa": "Bryozoa",
    "biota_ascidians": "Ascidians",
    "biota_octocoral_black": "Cnidaria",
    "biota_stony_corals": "Cnidaria",
    "biota_unconsolidated": "Substrate",
    "biota_consolidated": "Substrate",
}
BIOTA_LEVEL_3 = {
    "biota_unconsolidated": "Unconsolidated (soft)",
    "biota_consolidated": "Consolidated (hard)",
}
RELIEF_CODE = {
    "relief_0_flat_substrate_sandy_rubble_with_few_features_0_substrate_slope": 82003001,
    "relief_1_some_relief_features_amongst_mostly_flat_substrate_sand_rubble_45_degree_substrate_slope": 82003003,
    "relief_2_mostly_relief_features_amongst_some_flat_substrate_or_rubble_45_substrate_slope": 82003004,
    "relief_3_good_relief_structure_with_some_overhangs_45_substrate_slope": 82003006,
    "relief_4_high_structural_complexity_fissures_and_caves_vertical_wall_90_substrate_slope": 82003007,
}

# --- fixed values: the relief classes (code, levels 1 to 5) ----------------------------------
RELIEF_CLASSES = [
    (82003000, "Physical", "Relief", None, None, None),
    (82003001, "Physical", "Relief", "Flat", None, "0"),
    (82003003, "Physical", "Relief", "Low / moderate", "Low (<1m)", "1"),
    (82003004, "Physical", "Relief", "Low / moderate", "Moderate (1-3m)", "2"),
    (82003006, "Physical", "Relief", "High", "High (>3m)", "3"),
    (82003007, "Physical", "Relief", "High", "Wall", "4"),
    (82003008, "Physical", "Relief", "High", "Caves", "5"),
]

# --- fixed values: further known classes (code, levels 1 to 5) -------------------------------
KNOWN_CLASSES = [
    (2, "Biota", "Sessile invertebrates", "", "", None),
    (99900044, "Biota", "Sessile invertebrates", None, None, None),
    (10000000, "Biota", "Sponges", None, None, None),
    (10000902, "Biota", "Sponges", "Crusts", "Encrusting", None),
    (10000904, "Biota", "Sponges", "Massive forms", "Simple", None),
    (10000911, "Biota", "Sponges", "Cup-likes", "Tubes and chimneys", None),
    (10000915, "Biota", "Sponges", "Erect forms", "Branching", None),
    (11284000, "Biota", "Cnidaria", "Colonial anemones", "Zoanthids", None),
    (80300000, "Biota", "Macroalgae", None, None, None),
    (80300902, "Biota", "Macroalgae", "Large canopy-forming", "Brown", None),
    (80300910, "Biota", "Macroalgae", "Erect fine branching", "Red", None),
    (80300929, "Biota", "Macroalgae", "Encrusting", "Red", None),
]
