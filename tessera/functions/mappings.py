"""Keyword rules from free text to coded values."""

from __future__ import annotations

from tessera.functions.ladder import Ladder, Rule, exact, keywords

SOURCE_TYPE = Ladder((Rule("vision", any=("vision",)), Rule("both", any=("reconcil",)), Rule("derived", any=("enrich", "valid"))), "text", "text")

EPOCH_CODE = keywords(
    {"screening": "C98779", "treatment": "C98780", "follow-up": "C98777", "followup": "C98777", "washout": "C98781", "wash-out": "C98781", "run-in": "C98778", "runin": "C98778"},
    "C98780", "C98780",
)
EPOCH_DECODE = keywords(
    {
        "screening": "Screening Epoch", "treatment": "Treatment Epoch", "follow-up": "Follow-up Epoch", "followup": "Follow-up Epoch",
        "washout": "Washout Epoch", "wash-out": "Washout Epoch", "run-in": "Run-in Epoch", "runin": "Run-in Epoch",
    },
    "Treatment Epoch", "Treatment Epoch",
)
ENCOUNTER_CODE = keywords(
    {"screening": "C98779", "baseline": "C142615", "randomization": "C71738", "treatment": "C98780", "follow-up": "C98777", "followup": "C98777"}, "C98780", "C98780"
)
ENCOUNTER_DECODE = Ladder(
    (
        Rule("Screening Visit", any=("screening",)),
        Rule("Baseline Visit", any=("baseline",)),
        Rule("Randomization Visit", any=("randomization",)),
        Rule("Treatment Visit", any=("treatment",)),
        Rule("Follow-up Visit", any=("follow-up", "followup")),
        Rule("End of Study Visit", any=("end of study", "eos")),
        Rule("Early Termination Visit", any=("early termination",)),
        # a word of its own, where a plain substring would also hit 'diet'
        Rule("Early Termination Visit", like=r"\bet\b"),
        Rule("Unscheduled Visit", any=("unscheduled",)),
    ),
    "Study Visit", "Study Visit",
)
_ACTIVITY = {
    "procedure": {
        "blood": "Blood Collection", "urine": "Urine Collection", "sample": "Sample Collection", "biopsy": "Biopsy", "ecg": "ECG", "ekg": "ECG", "mri": "MRI",
        "ct scan": "CT Scan", "x-ray": "X-ray", "xray": "X-ray", "physical exam": "Physical Examination", "vital": "Vital Signs",
    },
    "assessment": {
        "questionnaire": "Questionnaire", "survey": "Survey", "scale": "Assessment Scale", "score": "Assessment Score", "diary": "Patient Diary", "cognitive": "Cognitive Assessment",
    },
    "lab": {"hematology": "Hematology", "chemistry": "Chemistry", "urinalysis": "Urinalysis", "serology": "Serology", "coagulation": "Coagulation"},
    "administration": {"dose": "Drug Administration", "infusion": "Infusion", "injection": "Injection", "administration": "Drug Administration"},
    "documentation": {"consent": "Informed Consent", "randomization": "Randomization", "enrollment": "Enrollment"},
}
ACTIVITY_CATEGORY = keywords({k: c for c, t in _ACTIVITY.items() for k in t}, "other", "other")
ACTIVITY_LABEL = keywords({k: v for t in _ACTIVITY.values() for k, v in t.items()}, "Study Activity", "Study Activity")

TITLE_TYPE = Ladder(
    (Rule("Brief Study Title", any=("brief", "short")), Rule("Study Acronym", any=("acronym",)), Rule("Scientific Study Title", any=("scientific",)), Rule("Public Study Title", any=("public",))),
    "Official Study Title", "Official Study Title",
)
ORGANIZATION_TYPE = Ladder(
    (
        Rule("Contract Research Organization", any=("cro", "contract")),
        Rule("Academic Institution", any=("academ", "university")),
        Rule("Regulatory Agency", any=("regulator", "fda", "ema")),
        Rule("Healthcare Facility", any=("hospital", "healthcare", "clinic")),
        Rule("Government Institute", any=("government",)),
        Rule("Laboratory", any=("lab",)),
        Rule("Clinical Study Registry", any=("registry",)),
        Rule("Medical Device Company", any=("device",)),
    ),
    "Pharmaceutical Company", "Pharmaceutical Company",
)
ROLE_CODE = Ladder(
    (
        Rule("Co-Sponsor", any=("co-sponsor", "cosponsor")),
        Rule("Local Sponsor", any=("local sponsor",)),
        Rule("Sponsor", any=("sponsor",)),
        Rule("Contract Research", any=("cro", "contract")),
        Rule("Principal investigator", any=("principal", "pi")),
        Rule("Investigator", any=("investigator",)),
        Rule("Regulatory Agency", any=("regulator",)),
        Rule("Manufacturer", any=("manufacturer",)),
        Rule("Statistician", any=("statistic",)),
    ),
    "Sponsor", "Sponsor",
)
ARM_TYPE = Ladder(
    (
        Rule("Placebo Comparator Arm", any=("placebo",)),
        Rule("Active Comparator Arm", every=("active", "comparator")),
        Rule("Sham Comparator Arm", any=("sham",)),
        Rule("No Intervention Arm", any=("no intervention", "no treatment")),
        Rule("Experimental Arm", any=("experimental",)),
    ),
    "Other Arm", "",
)
BLINDING = keywords({"quadruple": "Quadruple Blind", "triple": "Triple Blind", "double": "Double Blind", "single": "Single Blind", "open": "Open Label"}, "", "")
RANDOMIZATION = Ladder((Rule("Non-Randomized", any=("non", "not")), Rule("Randomized", any=("random",))), "", "")
CONTROL_TYPE = keywords(
    {"placebo": "Placebo Control", "active": "Active Control", "dose": "Dose Comparison", "historical": "Historical Control", "no treatment": "No Treatment"}, "Active Control", "Active Control"
)
INTERVENTION_ROLE = Ladder(
    (
        Rule("Placebo", any=("placebo",)),
        Rule("Comparator", any=("comparator",)),
        Rule("Rescue Medication", any=("rescue",)),
        Rule("Concomitant Medication", any=("concomitant",)),
        Rule("Background Therapy", any=("background",)),
        Rule("Investigational Product", any=("investigational", "study drug")),
    ),
    "", "",
)
DOSE_FORM = keywords(
    {
        "tablet": "Tablet", "capsule": "Capsule", "solution": "Solution", "suspension": "Suspension", "injection": "Injection", "cream": "Cream",
        "ointment": "Ointment", "gel": "Gel", "patch": "Patch", "powder": "Powder", "spray": "Spray", "inhaler": "Inhaler",
    },
    "Other",
)
ROUTE = Ladder(
    (
        Rule("Oral", any=("oral",)),
        Rule("Intravenous", any=("intravenous",)), Rule("Intravenous", equal=("iv",)),
        Rule("Subcutaneous", any=("subcutaneous",)), Rule("Subcutaneous", equal=("sc",)),
        Rule("Intramuscular", any=("intramuscular",)), Rule("Intramuscular", equal=("im",)),
        Rule("Topical", any=("topical",)), Rule("Inhalation", any=("inhalation",)), Rule("Intranasal", any=("intranasal",)),
        Rule("Ophthalmic", any=("ophthalmic",)), Rule("Transdermal", any=("transdermal",)), Rule("Rectal", any=("rectal",)), Rule("Sublingual", any=("sublingual",)),
    ),
    "Other",
)
FREQUENCY = Ladder(
    (
        *(Rule(v.upper() if v not in ("single", "continuous", "custom") else v.capitalize(), equal=(v,)) for v in ("qd", "bid", "tid", "qid", "qod", "qw", "q2w", "q3w", "q4w", "qm", "prn", "single", "continuous", "custom")),
        Rule("QD", any=("once daily", "once a day", "daily", "od", "qd", "q.d.")),
        Rule("BID", any=("twice daily", "twice a day", "bid", "b.i.d.")),
        Rule("TID", any=("three times", "tid", "t.i.d.", "3 times")),
        Rule("QID", any=("four times", "qid", "q.i.d.", "4 times")),
        Rule("Q3W", any=("q3w", "every 3 week", "every three week")),
        Rule("Q2W", any=("q2w", "every 2 week", "every two week", "biweekly")),
        Rule("Q4W", any=("q4w", "every 4 week", "monthly")),
        Rule("QW", any=("weekly", "once weekly", "qw", "q.w.", "every week", "once a week")),
        Rule("QOD", any=("every other day", "qod", "alternate day")),
        Rule("PRN", any=("as needed", "prn", "p.r.n.")),
        Rule("Single", any=("single", "one time", "one-time", "once")),
        Rule("Continuous", any=("continuous",)),
    ),
    "", "",
)
ROUTE_FLEXIBLE = Ladder(
    (
        *(Rule(v, equal=(v.lower(),)) for v in ("Oral", "IV", "SC", "IM", "Topical", "Inhalation", "Intranasal", "Transdermal", "Sublingual", "Rectal", "Ophthalmic", "Other")),
        *(Rule(v, equal=(k,)) for k, v in {"intravenous": "IV", "subcutaneous": "SC", "intramuscular": "IM"}.items()),
        Rule("Oral", any=("oral", "po", "by mouth", "tablet", "capsule")),
        Rule("IV", any=("intravenous", "iv", "i.v.", "infusion")),
        Rule("SC", any=("subcutaneous", "sc", "s.c.", "subq", "sub-q", "subcut")),
        Rule("IM", any=("intramuscular", "im", "i.m.")),
        Rule("Inhalation", any=("inhalation", "inhaled", "nebulized", "aerosol")),
        Rule("Topical", any=("topical", "cream", "ointment", "gel", "patch")),
        Rule("Transdermal", any=("transdermal",)),
        Rule("Intranasal", any=("nasal",)),
        Rule("Sublingual", any=("sublingual",)),
        Rule("Rectal", any=("rectal",)),
        Rule("Ophthalmic", any=("ophthalmic", "eye")),
        Rule("SC", any=("injection",)),
    ),
    "", "",
)
TIMING_TYPE = exact({"before": "Before", "after": "After", "within": "Within", "at": "At", "between": "Between"})
RELATIVE_TO = exact(
    {
        "study start": "Study Start", "randomization": "Randomization", "first dose": "First Dose", "last dose": "Last Dose", "previous visit": "Previous Visit",
        "screening": "Screening", "baseline": "Baseline", "end of treatment": "End of Treatment",
    }
)
TRANSITION_TYPE = exact(
    {
        "epoch transition": "Epoch Transition", "arm transition": "Arm Transition", "discontinuation": "Discontinuation", "early termination": "Early Termination",
        "rescue therapy": "Rescue Therapy", "dose modification": "Dose Modification",
    }
)
IMPACT_LEVEL = exact({"major": "Major", "minor": "Minor", "administrative": "Administrative"}, "Minor", "Minor")
CHANGE_TYPE = exact({"addition": "Addition", "deletion": "Deletion", "modification": "Modification", "clarification": "Clarification"}, "Modification", "Modification")
REASON_CATEGORY = exact(
    {"safety": "Safety", "efficacy": "Efficacy", "regulatory": "Regulatory", "operational": "Operational", "scientific": "Scientific", "administrative": "Administrative"},
    "Operational", "Operational",
)
PROCEDURE_TYPE = exact(
    {
        "diagnostic": "Diagnostic", "therapeutic": "Therapeutic", "surgical": "Surgical", "sampling": "Sample Collection", "sample collection": "Sample Collection",
        "imaging": "Imaging", "monitoring": "Monitoring", "assessment": "Assessment",
    }
)
DEVICE_TYPE = exact(
    {
        "drug delivery device": "Drug Delivery Device", "drug delivery": "Drug Delivery Device", "diagnostic device": "Diagnostic Device", "diagnostic": "Diagnostic Device",
        "monitoring device": "Monitoring Device", "monitoring": "Monitoring Device", "implantable device": "Implantable Device", "implantable": "Implantable Device",
        "wearable device": "Wearable Device", "wearable": "Wearable Device", "imaging equipment": "Imaging Equipment", "imaging": "Imaging Equipment",
        "laboratory equipment": "Laboratory Equipment", "laboratory": "Laboratory Equipment",
    }
)
SECTION_TYPE = keywords(
    {
        "synopsis": "Synopsis", "introduction": "Introduction", "objective": "Objectives", "design": "Study Design", "population": "Study Population",
        "eligibility": "Eligibility Criteria", "treatment": "Treatment", "procedure": "Study Procedures", "assessment": "Assessments", "safety": "Safety",
        "statistic": "Statistics", "ethic": "Ethics", "reference": "References", "appendix": "Appendix", "abbreviation": "Abbreviations", "title": "Title Page",
        "content": "Table of Contents",
    },
    "Other", "Other",
)
STRATEGY = Ladder(
    (
        Rule("Composite", any=("composite",)), Rule("Hypothetical", any=("hypothetical",)), Rule("Principal Stratum", any=("principal", "stratum")),
        Rule("While on Treatment", any=("while on",)),
    ),
    "Treatment Policy", "Treatment Policy",
)
TIMING_ANCHOR = Ladder(
    (
        Rule("Visit", any=("day 1", "day1", "baseline", "screening", "visit", "check-in", "checkin", "admission", "discharge", "end of study", "eos", "follow-up", "followup")),
        Rule("Event", any=("first dose", "dose", "randomization", "randomisation", "informed consent", "enrollment", "enrolment", "treatment start", "drug admin")),
    ),
    "Conceptual", "Conceptual",
)
ANCHOR_CLASS = exact(
    {
        "screening": "Visit", "day1": "Visit", "baseline": "Visit", "firstdose": "Event", "treatmentstart": "Event", "randomization": "Event",
        "informedconsent": "Event", "enrollment": "Event",
    },
    "Conceptual", "Conceptual",
)
ERROR_CATEGORY = Ladder(
    (
        Rule("transient", any=("timeout", "timed out", "rate limit", "429", "503", "502", "connection reset", "connection refused", "temporary", "service unavailable", "retry", "throttl")),
        Rule("configuration", any=("api key", "api_key", "apikey", "authentication", "unauthorized", "401", "403", "forbidden", "invalid model", "model not found", "missing config", "not configured")),
        Rule("resource", any=("out of memory", "oom", "disk full", "no space", "memory error", "resource exhausted", "quota exceeded")),
        Rule("permanent", any=("valueerror", "typeerror", "keyerror", "attributeerror", "filenotfounderror")),
    ),
    "unknown", "unknown",
)
IDENTIFIER_EXPLICIT = Ladder(
    (
        Rule("NCT", any=("nct", "clinicaltrials")), Rule("EudraCT", any=("eudract",)), Rule("SponsorProtocolNumber", any=("sponsor", "protocol")),
        Rule("IND", any=("ind",), but=("ide",)), Rule("IDE", any=("ide",)), Rule("ISRCTN", any=("isrctn",)), Rule("CTIS", any=("ctis",)), Rule("WHO_UTN", any=("utn", "who")),
    ),
)
IDENTIFIER_PATTERN = Ladder(
    (
        Rule("NCT", like=r"^\s*nct\d{8}\s*$"), Rule("EudraCT", like=r"^\d{4}-\d{6}-\d{2}$"), Rule("ISRCTN", like=r"^\s*isrctn\d+\s*$"),
        Rule("IND", like=r"^\s*ind\s*\d+"), Rule("IDE", like=r"^\s*ide\s*\d+"),
    ),
)
IDENTIFIER_DEFAULT = Ladder((Rule("SponsorProtocolNumber", like=r"^\s*[a-z]{2,5}[-_]?\d+"), Rule("SponsorProtocolNumber", any=("-",))), "Other", "Other")

#: name of the ladder -> (survey row, ladder)
LADDERS: dict[str, tuple[str, Ladder]] = {
    "source_type": ("i28", SOURCE_TYPE), "epoch_code": ("i29", EPOCH_CODE), "epoch_decode": ("i29", EPOCH_DECODE), "encounter_code": ("i30", ENCOUNTER_CODE),
    "encounter_decode": ("i30", ENCOUNTER_DECODE), "activity_category": ("i31", ACTIVITY_CATEGORY), "activity_label": ("i31", ACTIVITY_LABEL),
    "identifier_explicit": ("i32", IDENTIFIER_EXPLICIT), "identifier_pattern": ("i32", IDENTIFIER_PATTERN), "identifier_default": ("i32", IDENTIFIER_DEFAULT),
    "title_type": ("i33", TITLE_TYPE), "organization_type": ("i33", ORGANIZATION_TYPE), "role_code": ("i33", ROLE_CODE),
    "arm_type": ("i34", ARM_TYPE), "blinding": ("i34", BLINDING), "randomization": ("i34", RANDOMIZATION), "control_type": ("i34", CONTROL_TYPE),
    "intervention_role": ("i35", INTERVENTION_ROLE), "dose_form": ("i35", DOSE_FORM), "route": ("i35", ROUTE), "frequency": ("i36", FREQUENCY),
    "route_flexible": ("i37", ROUTE_FLEXIBLE), "timing_type": ("i39", TIMING_TYPE), "relative_to": ("i39", RELATIVE_TO), "transition_type": ("i39", TRANSITION_TYPE),
    "impact_level": ("i40", IMPACT_LEVEL), "change_type": ("i40", CHANGE_TYPE), "reason_category": ("i40", REASON_CATEGORY),
    "procedure_type": ("i41", PROCEDURE_TYPE), "device_type": ("i41", DEVICE_TYPE), "section_type": ("i42", SECTION_TYPE), "strategy": ("i43", STRATEGY),
    "timing_anchor": ("i44", TIMING_ANCHOR), "anchor_class": ("i45", ANCHOR_CLASS), "error_category": ("i57", ERROR_CATEGORY),
}
