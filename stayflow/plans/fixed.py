"""Canonical tables and the fixed values that harmonization needs."""

from __future__ import annotations

from collections.abc import Mapping

# Names of raw columns of the static and of the time-series exports, and the canonical column of each.
STATIC_TRANSLATION = {
    "BMI": "bmi_group",
    "Beatmungsfreie_Tage": "vent_free_days",
    "Cluster-ID": "cluster_id",
    "ClusterAlter": "age_group",
    "ClusterGeschlecht": "sex",
    "ClusterKoerperGewicht": "weight_group",
    "ClusterKoerpergroesse": "height_group",
    "Dialyse_(dialysefreie_Tage)": "dialysis_free_days",
    "Entlassgrund_(verlegt_intern,_verlegt_extern,_verstorben)": "discharge_status",
    "ICD-10_Codes": "icd10_codes",
    "Liegedauer_ICU": "icu_los",
    "Liegedauer_KH": "hosp_los",
    "Phase": "phase",
    "Pseudo-ID": "stay_id",
    "PseudoID": "stay_id",
    "Sterblichkeit": "death_status",
    "Wiederaufnahme_ICU": "icu_readmit",
    "Zeit_seit_Studienbeginn": "study_day",
    "clusterAlter": "age_group",
    "clusterGeschlecht": "sex",
    "clusterKoerpergewicht": "weight_group",
    "clusterKoerpergroesse": "height_group",
}

DYNAMIC_TRANSLATION = {
    "24h-Bilanz_(Fluessigkeiten-Einfuhr_vs_-Ausfuhr)": "fluid_balance_24h",
    "AF": "resp_rate",
    "AF_spontan": "spont_resp_rate",
    "Albumin": "albumin",
    "Amylase": "amylase",
    "BE_arteriell": "base_excess_art",
    "BNP": "bnp",
    "Bicarbonat_arteriell": "bicarbonate_art",
    "Bilirubin_ges.": "bilirubin_total",
    "CK": "ck",
    "CK-MB": "ck_mb",
    "CRP": "crp",
    "Clonidin_intravenoes_kontinuierlich": "clonidine_iv_cont",
    "Compliance": "compliance",
    "Creatinkinase": "ck",
    "D-Dimere": "d_dimer",
    "DAP": "dbp",
    "DPAP": "pap_dias",
    "Dexamethason_intravenoes_bolusweise": "dexamethasone_iv_bolus",
    "Dexmedetomidin_intravenoes_kontinuierlich": "dexmedetomidine_iv_cont",
    "Dobutamin_intravenoes_kontinuierlich": "dobutamine_iv_cont",
    "ECMO": "ecmo",
    "ECMO_FiO2": "ecmo_o2",
    "EVLWI": "evlwi",
    "Epinephrin_intravenoes_kontinuierlich": "epinephrine_iv_cont",
    "Extrakorporaler_Blutfluss": "extracorp_blood_flow",
    "Extrakorporaler_Gasfluss_(O2)": "extracorp_o2_flow",
    "FeO2": "feo2",
    "Fentanyl_intravenoes_kontinuierlich": "fentanyl_iv_cont",
    "FiO2": "fio2",
    "Fludrocortison_peroral_bolusweise": "fludrocortisone_po_bolus",
    "Furosemid_intravenoes_kontinuierlich": "furosemide_iv_cont",
    "GEDVI": "gedvi",
    "GOT": "ast",
    "GPT": "alt",
    "Gaszusammensetzung_(%O2)": "ecmo_o2",
    "HF": "heart_rate",
    "HI_(Bolus)": "cardiac_index_bolus",
    "HI_(kontinuierlich)": "cardiac_index_cont",
    "HZV_(Bolus)": "cardiac_output_bolus",
    "HZV_(kontinuierlich)": "cardiac_output_cont",
    "Haematokrit": "hematocrit",
    "Haemoglobin": "hemoglobin",
    "Harnstoff": "urea",
    "Horowitz-Quotient_(ohne_Temp-Korrektur)": "pf_ratio",
    "Hydrocortison_intravenoes_bolusweise": "hydrocortisone_iv_bolus",
    "I:E": "ie_ratio",
    "IL-6": "il6",
    "INR": "inr",
    "Inhalatives_Iloprost": "inhaled_iloprost",
    "Inhalatives_NO": "inhaled_no",
    "Interleukin_6": "il6",
    "Isofluran_inhalativ": "isoflurane_inh",
    "Ketanest_intravenoes_kontinuierlich": "ketanest_iv_cont",
    "Koerperkerntemperatur": "core_temp",
    "Koerpertemperatur": "core_temp",
    "Kreatinin": "creatinine",
    "LDH": "ldh",
    "Lagerungstherapie": "position_therapy",
    "Laktat_arteriell": "lactate_art",
    "Leukozyten": "wbc",
    "Levosimendan_intravenoes_kontinuierlich": "levosimendan_iv_cont",
    "Lipase": "lipase",
    "Lymphocyten": "lymph_pct",
    "Lymphozyten_absolut": "lymph_abs",
    "Lymphozyten_prozentual": "lymph_pct",
    "MAP": "map",
    "MPAP": "pap_mean",
    "Midazolam_intravenoes_kontinuierlich": "midazolam_iv_cont",
    "Milrinon_intravenoes_kontinuierlich": "milrinone_iv_cont",
    "Morphin_intravenoes_kontinuierlich": "morphine_iv_cont",
    "NT-proBNP": "ntprobnp",
    "NT-pro_BNP": "ntprobnp",
    "Norepinephrin_intravenoes_kontinuierlich": "norepinephrine_iv_cont",
    "Organversagen:_SOFA_Score_ohne_GCS": "sofa",
    "PCT": "pct",
    "PCWP": "pcwp",
    "PEEP": "peep",
    "PVRI": "pvri",
    "P_EI": "insp_pressure",
    "Prednisolon_intravenoes_bolusweise": "prednisolone_iv_bolus",
    "Propofol_intravenoes_kontinuierlich": "propofol_iv_cont",
    "Pseudo-ID": "stay_id",
    "PseudoID": "stay_id",
    "Rocuronium_intravenoes_bolusweise": "rocuronium_iv_bolus",
    "SAP": "sbp",
    "SOFA": "sofa",
    "SPAP": "pap_sys",
    "SVI_(Bolus)": "stroke_index_bolus",
    "SVI_(kontinuierlich)": "stroke_index_cont",
    "SVRI": "svri",
    "SV_(Bolus)": "stroke_volume_bolus",
    "SV_(kontinuierlich)": "stroke_volume_cont",
    "SaO2": "sao2",
    "Sevofluran_inhalativ": "sevoflurane_inh",
    "SpO2": "spo2",
    "Sufentanil_intravenoes_kontinuierlich": "sufentanil_iv_cont",
    "SzvO2": "scvo2",
    "Terlipressin_intravenoes_bolusweise": "terlipressin_iv_bolus",
    "Thrombozyten": "platelets",
    "Time": "time",
    "Troponin": "troponin",
    "Vasopressin_intravenoes_kontinuierlich": "vasopressin_iv_cont",
    "Vt": "vt",
    "ZVD": "cvp",
    "Zeit_ab_Aufnahme": "minutes_since_admit",
    "deltaP": "delta_p",
    "etCO2": "etco2",
    "individuelles_Tidalvolumen_pro_kg_idealem_Koerpergewicht": "vt_per_kg_ibw",
    "pH_arteriell": "ph_art",
    "pTT": "ptt",
    "paCO2_(ohne_Temp-Korrektur)": "paco2",
    "paO2_(ohne_Temp-Korrektur)": "pao2",
}

# The time series' columns by clinical theme.
THEMES = {
    "vitals": ["heart_rate", "sbp", "map", "dbp", "resp_rate", "spont_resp_rate", "core_temp", "spo2", "sao2", "scvo2", "cvp"],
    "ventilation": ["fio2", "feo2", "peep", "delta_p", "insp_pressure", "compliance", "ie_ratio", "vt", "vt_per_kg_ibw", "etco2", "pf_ratio"],
    "blood_gas": ["pao2", "paco2", "ph_art", "bicarbonate_art", "base_excess_art", "lactate_art"],
    "hemodynamics": ["pap_sys", "pap_mean", "pap_dias", "pcwp", "cardiac_output_bolus", "cardiac_output_cont", "cardiac_index_bolus", "cardiac_index_cont", "stroke_volume_bolus", "stroke_volume_cont", "stroke_index_bolus", "stroke_index_cont", "svri", "pvri", "gedvi", "evlwi"],
    "hematology_coag": ["hemoglobin", "hematocrit", "wbc", "platelets", "lymph_abs", "lymph_pct", "inr", "ptt", "d_dimer"],
    "chemistry_inflammation": ["albumin", "crp", "pct", "il6", "bilirubin_total", "urea", "creatinine", "bnp", "ntprobnp", "ast", "alt", "ldh", "amylase", "lipase", "troponin", "ck", "ck_mb"],
    "support_therapy": ["fluid_balance_24h", "position_therapy", "ecmo", "ecmo_o2", "extracorp_blood_flow", "extracorp_o2_flow", "inhaled_no", "inhaled_iloprost"],
    "vasoactive_inotrope": ["dobutamine_iv_cont", "epinephrine_iv_cont", "norepinephrine_iv_cont", "vasopressin_iv_cont", "milrinone_iv_cont", "levosimendan_iv_cont", "terlipressin_iv_bolus"],
    "sedation_analgesia": ["propofol_iv_cont", "midazolam_iv_cont", "clonidine_iv_cont", "dexmedetomidine_iv_cont", "ketanest_iv_cont", "isoflurane_inh", "sevoflurane_inh", "sufentanil_iv_cont", "fentanyl_iv_cont", "morphine_iv_cont", "rocuronium_iv_bolus"],
    "other_meds": ["furosemide_iv_cont", "hydrocortisone_iv_bolus", "prednisolone_iv_bolus", "dexamethasone_iv_bolus", "fludrocortisone_po_bolus"],
    "scores": ["sofa"],
}

# Bounds outside which a value is invalid: variable, least, most, whether zero is invalid.
INVALID_VALUE_RULES = [
    ("albumin", None, None, True),
    ("cardiac_index_bolus", 0.0, 15.0, True),
    ("cardiac_index_cont", 0.0, 15.0, True),
    ("cardiac_output_bolus", 0.0, 25.0, True),
    ("cardiac_output_cont", 0.0, 25.0, True),
    ("compliance", 0.0, 300.0, True),
    ("core_temp", 25.0, 45.0, False),
    ("creatinine", None, None, True),
    ("cvp", -20.0, 60.0, False),
    ("dbp", 0.0, 200.0, True),
    ("delta_p", 0.0, 60.0, False),
    ("evlwi", 0.0, 80.0, True),
    ("fio2", 20.0, 100.0, False),
    ("gedvi", 0.0, 2000.0, True),
    ("heart_rate", 0.0, 250.0, True),
    ("hematocrit", 0.0, 80.0, True),
    ("hemoglobin", 0.0, 25.0, True),
    ("ie_ratio", 0.0, 10.0, True),
    ("inr", 0.0, 15.0, True),
    ("insp_pressure", 0.0, 80.0, False),
    ("lactate_art", 0.0, 30.0, True),
    ("map", 0.0, 250.0, True),
    ("paco2", 0.0, 150.0, True),
    ("pao2", 0.0, 760.0, True),
    ("pap_dias", 0.0, 100.0, True),
    ("pap_mean", 0.0, 100.0, True),
    ("pap_sys", 0.0, 150.0, True),
    ("pcwp", 0.0, 50.0, True),
    ("peep", 0.0, 30.0, False),
    ("pf_ratio", 0.0, 2500.0, True),
    ("ph_art", 6.8, 7.8, False),
    ("platelets", 0.0, 2000.0, True),
    ("ptt", 0.0, 300.0, True),
    ("resp_rate", 0.0, 80.0, True),
    ("sao2", 50.0, 100.0, False),
    ("sbp", 0.0, 300.0, True),
    ("scvo2", 20.0, 100.0, False),
    ("sofa", 0.0, 24.0, False),
    ("spo2", 30.0, 100.0, False),
    ("stroke_index_cont", 0.0, 100.0, True),
    ("stroke_volume_cont", 0.0, 300.0, True),
    ("svri", 0.0, 10000.0, True),
    ("vt", 0.0, 2000.0, True),
    ("vt_per_kg_ibw", 0.0, 30.0, True),
]

# Columns of the static table, those that are whole numbers, those where -1 stands for missing; recodes.
STATIC_COLUMNS = ["hospital_id", "stay_id_global", "stay_id_local", "age_group", "sex", "height_group", "weight_group", "bmi_group", "hosp_mortality", "icu_mortality", "hosp_los", "icu_los", "icu_readmit", "dialysis_free_days", "vent_free_days", "icd10_codes"]
STATIC_NUMBERS = ["hosp_mortality", "icu_mortality", "hosp_los", "icu_los", "icu_readmit", "dialysis_free_days", "vent_free_days"]
MINUS_ONE_MISSING = ["weight_group", "hosp_los", "icu_los", "icu_readmit", "dialysis_free_days", "vent_free_days"]
STATIC_DROPPED = ["cluster_id", "study_day", "phase"]
BMI_GROUPS = {"L": "Underweight", "M": "Normal Weight", "P": "Overweight", "1": "Obesity Class 1", "2": "Obesity Class 2", "3": "Obesity Class 3"}
BMI_MISSING = ["X", "NAN"]
PREFIX_COLUMNS = ["hospital_id", "stay_id_global", "stay_id_local", "time", "minutes_since_admit"]
TEXT_COLUMNS = ["hospital_id", "stay_id_global", "stay_id_local", "time"]

# Site-specific actions (hospital, variable, action, factor) and what a decision is made on.
SEMANTIC_TARGETS = ["norepinephrine_iv_cont", "clonidine_iv_cont", "vt_per_kg_ibw", "etco2", "ie_ratio"]
SEMANTIC_ACTIONS = [("asic_UK04", "etco2", "divide", 7.50062), ("asic_UK06", "vt_per_kg_ibw", "set_missing", None), ("asic_UK03", "norepinephrine_iv_cont", "set_missing", None), ("asic_UK08", "clonidine_iv_cont", "set_missing", None)]
SEMANTIC_REVIEW = ["ie_ratio"]
LABORATORY_SITE = "asic_UK04"

# What a site must measure, the optional group, the markers of ventilation support, the model's variables.
VITAL_GROUPS = {"cardiac_rate": ["heart_rate"], "blood_pressure": ["map", "sbp", "dbp"], "respiratory": ["resp_rate"], "oxygenation": ["spo2", "sao2"], "core_temp_optional": ["core_temp"]}
OPTIONAL_GROUPS = ["core_temp_optional"]
SUPPORT_MARKERS = ["fio2", "peep", "vt", "vt_per_kg_ibw"]
MODEL_VARIABLES = ["heart_rate", "map", "sbp", "dbp", "resp_rate", "spo2", "sao2", "core_temp"]


def dynamic_columns() -> list[str]:
    """Prefix columns, then the variables by theme; a variable in two themes or in none is an error."""
    ordered = [v for vs in THEMES.values() for v in vs]
    known = set(DYNAMIC_TRANSLATION.values()) - {"stay_id", "time", "minutes_since_admit"}
    twice, loose = {v for v in ordered if ordered.count(v) > 1}, known ^ set(ordered)
    if twice or loose:
        raise ValueError(f"variables in two themes {sorted(twice)}, in none or unknown {sorted(loose)}")
    return PREFIX_COLUMNS + ordered


def raw_columns(section: str, translation: Mapping[str, str] | None = None) -> dict[str, list[str]]:
    """The raw columns of each canonical one, in the translation's order (the built-in one, unless another is given)."""
    table = translation or (STATIC_TRANSLATION if section == "static" else DYNAMIC_TRANSLATION)
    renamed = {"stay_id": "stay_id_local"} | ({"discharge_status": "hosp_mortality", "death_status": "icu_mortality"} if section == "static" else {})
    out: dict[str, list[str]] = {}
    for raw, name in table.items():
        if section != "static" or name not in STATIC_DROPPED:
            out.setdefault(renamed.get(name, name), []).append(raw)
    return out


# Metrics of the stay level and their notes.
SUMMARY_NOTES = {
    "rows": "Authoritative ASIC stay-level cohort rows.",
    "unique_stays": "Unique stay_id_global values in the authoritative stay-level table.",
    "with_end": "Stays with at least one observed harmonized dynamic time value.",
    "without_end": "Stays with no usable dynamic time extent and therefore missing icu_end_time_proxy.",
    "icu_end_time_proxy_is_recording_extent_proxy": "ASIC ICU stay end is proxy-based rather than a true administrative discharge timestamp.",
}
