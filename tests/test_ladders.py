"""Results of the keyword rules, written down by hand and not taken from the rules."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.mappings import LADDERS

WANTED = {
    "source_type": {"soa_vision_agent": "vision", "reconciliation_agent": "both", "quality_enrichment": "derived", "schema_validator": "derived", "soa_text_agent": "text", "": "text"},
    "epoch_code": {"Screening 2": "C98779", "Open-label Treatment": "C98780", "Safety Follow-Up": "C98777", "FOLLOWUP": "C98777", "Wash-out": "C98781", "Run-in": "C98778", "Anything": "C98780"},
    "epoch_decode": {"screening before treatment": "Screening Epoch", "washout": "Washout Epoch", "runin": "Run-in Epoch", "x": "Treatment Epoch"},
    "encounter_decode": {"Baseline visit": "Baseline Visit", "EOS": "End of Study Visit", "Early Termination": "Early Termination Visit", "ET": "Early Termination Visit", "Diet": "Study Visit", "Unscheduled": "Unscheduled Visit", "Randomization": "Randomization Visit"},
    "activity_category": {"Blood draw": "procedure", "Pain score": "assessment", "Haematology": "other", "Hematology panel": "lab", "IV infusion": "administration", "Informed consent": "documentation"},
    "activity_label": {"12-lead ECG": "ECG", "EKG": "ECG", "Vital signs": "Vital Signs", "Walk": "Study Activity", "Urinalysis": "Urinalysis"},
    "title_type": {"Brief title": "Brief Study Title", "short": "Brief Study Title", "Acronym": "Study Acronym", "Public title": "Public Study Title", "": "Official Study Title"},
    "organization_type": {"CRO": "Contract Research Organization", "University X": "Academic Institution", "FDA": "Regulatory Agency", "Hospital": "Healthcare Facility", "": "Pharmaceutical Company"},
    "arm_type": {"Placebo": "Placebo Comparator Arm", "ACTIVE comparator": "Active Comparator Arm", "active": "Other Arm", "Sham": "Sham Comparator Arm", "No treatment": "No Intervention Arm", "Experimental": "Experimental Arm", "": ""},
    "blinding": {"Quadruple": "Quadruple Blind", "double-blind": "Double Blind", "Open label": "Open Label", "masked": "", "": ""},
    "randomization": {"Non-randomized": "Non-Randomized", "not randomized": "Non-Randomized", "Randomized": "Randomized", "sequential": "", "": ""},
    "control_type": {"placebo and active": "Placebo Control", "Dose comparison": "Dose Comparison", "Historical": "Historical Control", "no treatment": "No Treatment", "other": "Active Control"},
    "intervention_role": {"Rescue medication": "Rescue Medication", "Comparator": "Comparator", "Study drug": "Investigational Product", "Background": "Background Therapy", "x": "", "": ""},
    "dose_form": {"film-coated tablet": "Tablet", "Powder for injection": "Injection", "gel capsule": "Capsule", "lozenge": "Other", "": None},
    "route": {"oral": "Oral", "IV": "Intravenous", "IVX": "Other", "sc": "Subcutaneous", "im": "Intramuscular", "Inhalation": "Inhalation", "": None},
    "frequency": {"once daily": "QD", "bid": "BID", "3 times a day": "TID", "4 times": "QID", "every 3 weeks": "Q3W", "biweekly": "Q2W", "monthly": "Q4W", "once a week": "QW", "alternate day": "QOD", "as needed": "PRN", "one-time": "Single", "continuous": "Continuous", "?": "", "": ""},
    "route_flexible": {"by mouth": "Oral", "capsule": "Oral", "i.v. push": "IV", "infusion": "IV", "subq": "SC", "aerosol": "Inhalation", "cream": "Topical", "transdermal": "Transdermal", "nasal spray": "Intranasal", "eye drops": "Ophthalmic", "injection": "SC", "": ""},
    "section_type": {"Study objectives": "Objectives", "Study design": "Study Design", "Ethical": "Ethics", "Appendix A": "Appendix", "Title page": "Title Page", "Contents": "Table of Contents", "zzz": "Other"},
    "strategy": {"Composite": "Composite", "Principal": "Principal Stratum", "stratum": "Principal Stratum", "While on treatment": "While on Treatment", "treatment policy": "Treatment Policy"},
    "timing_anchor": {"Day 1": "Visit", "First dose": "Event", "First dose visit": "Visit", "Cycle 2": "Conceptual", "Informed consent": "Event", "": "Conceptual"},
    "anchor_class": {"Screening": "Visit", "Day1": "Visit", "FirstDose": "Event", "Enrollment": "Event", "CycleStart": "Conceptual", "Custom": "Conceptual"},
    "error_category": {"Rate limit": "transient", "HTTP 503": "transient", "bad API key": "configuration", "Disk full": "resource", "KeyError: x": "permanent", "odd": "unknown"},
    "impact_level": {"Major": "Major", "administrative": "Administrative", "x": "Minor", "": "Minor"},
    "timing_type": {"Before": "Before", "between": "Between", "sometime": None},
}


@pytest.mark.parametrize("name", sorted(WANTED))
def test_ladder(spark, name):
    want = WANTED[name]
    df = spark.createDataFrame([(t,) for t in want], "t string")
    got = {r["t"]: r["m"] for r in df.select("t", LADDERS[name][1].column(F.col("t")).alias("m")).collect()}
    assert got == want
