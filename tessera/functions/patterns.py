"""Patterns of schedules, repetitions and conditions in protocol text."""

#: (pattern, anchor type), tried in this order
ANCHORS = [
    (r"first\s+(?:dose|administration)\s+of\s+(?:study\s+)?(?:drug|medication|treatment|investigational\s+product)", "FirstDose"),
    (r"day\s+1\s+(?:of\s+)?(?:cycle\s+1|treatment|dosing)", "FirstDose"),
    (r"initiation\s+of\s+(?:study\s+)?treatment", "FirstDose"),
    (r"start\s+of\s+(?:study\s+)?(?:treatment|therapy|intervention)", "FirstDose"),
    (r"treatment\s+(?:start|initiation|commencement)", "FirstDose"),
    (r"day\s+(?:of\s+)?randomization", "Randomization"),
    (r"randomization\s+(?:visit|day|date)", "Randomization"),
    (r"days?\s+(?:from|after|since)\s+randomization", "Randomization"),
    (r"post[\-\s]?randomization", "Randomization"),
    (r"day\s+1\s*[=:]\s*(?:baseline|first\s+visit)", "Day1"),
    (r"baseline\s+(?:visit|day|assessment)", "Baseline"),
    (r"week\s+0\s+(?:of\s+)?treatment", "Baseline"),
    (r"pre[\-\s]?treatment\s+(?:baseline|assessment)", "Baseline"),
    (r"screening\s+(?:visit|period|day)", "Screening"),
    (r"informed\s+consent", "InformedConsent"),
    (r"enrollment\s+(?:visit|day)", "Enrollment"),
    (r"cycle\s+1[,\s]+day\s+1", "CycleStart"),
    (r"c1d1", "CycleStart"),
    (r"first\s+(?:infusion|injection)\s+(?:of\s+)?(?:study\s+)?(?:drug|treatment)", "FirstDose"),
    (r"start\s+of\s+(?:chemotherapy|immunotherapy|targeted\s+therapy)", "FirstDose"),
    (r"day\s+1\s+of\s+(?:induction|consolidation|maintenance)", "FirstDose"),
    (r"first\s+(?:cycle|course)\s+of\s+(?:treatment|therapy)", "CycleStart"),
    (r"(?:first|prime)\s+(?:vaccination|immunization|dose)", "FirstDose"),
    (r"day\s+(?:of\s+)?(?:prime|first)\s+vaccination", "FirstDose"),
    (r"vaccination\s+day\s+(?:1|one)", "FirstDose"),
    (r"post[\-\s]?vaccination\s+day\s+\d+", "FirstDose"),
    (r"challenge\s+(?:day|date)", "Custom"),
    (r"(?:index|qualifying)\s+(?:event|mi|stroke|hospitalization)", "Custom"),
    (r"days?\s+(?:from|after|since)\s+(?:index|qualifying)\s+event", "Custom"),
    (r"post[\-\s]?(?:mi|stroke|pci|cabg)", "Custom"),
    (r"hospital\s+discharge", "Custom"),
    (r"days?\s+(?:from|after)\s+discharge", "Custom"),
    (r"(?:first|initial)\s+(?:seizure|episode|attack)", "Custom"),
    (r"symptom\s+onset", "Custom"),
    (r"days?\s+(?:from|after|since)\s+(?:diagnosis|onset)", "Custom"),
    (r"titration\s+(?:start|initiation|period)", "FirstDose"),
    (r"(?:day\s+of\s+)?(?:surgery|procedure|implantation|transplant)", "Custom"),
    (r"post[\-\s]?(?:operative|surgical|procedure)", "Custom"),
    (r"days?\s+(?:from|after|since)\s+(?:surgery|procedure|implant)", "Custom"),
    (r"device\s+(?:implantation|activation)", "Custom"),
    (r"transplant(?:ation)?\s+(?:day|date)", "Custom"),
    (r"first\s+(?:infusion|injection)\s+of\s+(?:enzyme|gene\s+therapy|replacement)", "FirstDose"),
    (r"start\s+of\s+(?:enzyme|gene)\s+(?:replacement\s+)?therapy", "FirstDose"),
    (r"loading\s+dose", "FirstDose"),
    (r"(?:first|initial)\s+(?:injection|dose)\s+of\s+(?:insulin|glp[\-\s]?1|sglt)", "FirstDose"),
    (r"start\s+of\s+(?:insulin|basal|bolus)\s+(?:therapy|treatment)", "FirstDose"),
    (r"clamp\s+(?:procedure|study)\s+(?:day|start)", "Custom"),
    (r"glucose\s+(?:challenge|tolerance\s+test)", "Custom"),
    (r"first\s+dose\s+of\s+(?:antibiotic|antiviral|antifungal)", "FirstDose"),
    (r"start\s+of\s+(?:antimicrobial|antiretroviral)\s+therapy", "FirstDose"),
    (r"(?:infection|symptom)\s+(?:onset|diagnosis)", "Custom"),
    (r"(?:first|initial)\s+(?:intravitreal\s+)?injection", "FirstDose"),
    (r"day\s+of\s+(?:injection|treatment)\s+(?:in\s+)?(?:study|treated)\s+eye", "FirstDose"),
    (r"first\s+(?:application|dose)\s+of\s+(?:topical|study)\s+(?:drug|treatment)", "FirstDose"),
    (r"start\s+of\s+(?:topical|phototherapy)\s+treatment", "FirstDose"),
]
ANCHOR_ORDER = ["FirstDose", "Randomization", "Day1", "Baseline", "CycleStart", "Enrollment", "Screening", "InformedConsent", "Custom"]
DAILY = [
    r"daily\s+(?:urine|blood|sample|collection|measurement|assessment)", r"once\s+daily", r"every\s+day", r"each\s+day\s+(?:of|during)",
    r"(?:collect|measure|assess)\s+daily", r"(?:qd|q\.d\.|od)", r"daily\s+(?:glucose|blood\s+sugar|bg)\s+(?:monitoring|measurement)",
    r"(?:smbg|self[\-\s]?monitoring)\s+daily", r"daily\s+(?:diary|log)\s+(?:entry|entries)", r"daily\s+weight",
    r"daily\s+(?:blood\s+pressure|bp)\s+(?:monitoring|measurement)", r"daily\s+(?:heart\s+rate|hr|pulse)", r"daily\s+(?:ecg|ekg|holter)",
    r"daily\s+(?:oral|po)\s+(?:dosing|administration)", r"daily\s+(?:symptom|toxicity)\s+(?:assessment|diary)",
    r"daily\s+(?:seizure|headache|migraine)\s+(?:diary|log)", r"daily\s+(?:pain|symptom)\s+(?:score|rating)",
    r"daily\s+(?:enzyme|substrate|biomarker)\s+(?:level|measurement)", r"daily\s+(?:temperature|fever)\s+(?:monitoring|check)",
    r"daily\s+(?:viral|bacterial)\s+(?:load|count)",
]
#: Sampling at an interval; the first group, where there is one, is an amount or a list of times
INTERVALS = [
    r"every\s+(\d+)\s*(?:min(?:ute)?s?)",
    r"at\s+(?:time\s+)?(\d+(?:,\s*\d+)+)\s*(?:min(?:ute)?s?)",
    r"(\d+)\s*(?:min(?:ute)?s?)\s+intervals?",
    r"q(\d+)min",
    r"every\s+(\d+)\s*(?:hour|hr)s?",
    r"(\d+)\s*(?:hour|hr)s?\s+intervals?",
    r"q(\d+)h",
    r"(?:bid|b\.i\.d\.)",
    r"(?:tid|t\.i\.d\.)",
    r"(?:qid|q\.i\.d\.)",
    r"(?:pk|pharmacokinetic)\s+(?:samples?|sampling)\s+(?:at|:)\s*([\d,\s\.]+)",
    r"(?:pd|pharmacodynamic)\s+(?:samples?|sampling)\s+(?:at|:)\s*([\d,\s\.]+)",
    r"(?:0|pre[\-\s]?dose)[,\s]+(\d+(?:[,\s]+\d+)*)\s*(?:min|hour|hr)",
    r"time\s+(?:0|zero)[,\s]+(\d+(?:[,\s]+\d+)*)",
    r"glucose\s+(?:every|q)\s*(\d+)\s*(?:min|hour|hr)",
    r"(?:cgm|continuous\s+glucose)",
    r"glucose\s+at\s+(\d+(?:,\s*\d+)+)\s*(?:min|hour)",
    r"(?:ecg|ekg|bp)\s+(?:every|q)\s*(\d+)\s*(?:min|hour|hr)",
    r"(?:holter|ambulatory)\s+(?:monitoring|ecg)",
    r"post[\-\s]?(?:vaccination|injection)\s+(?:at|every)\s*(\d+)\s*(?:min|hour)",
    r"observation\s+(?:period|every)\s*(\d+)\s*(?:min|hour)",
    r"(?:during|post)\s+infusion\s+(?:at|every)\s*(\d+)\s*(?:min|hour)",
    r"infusion[\-\s]?related\s+(?:monitoring|assessment)",
]
#: Treatment cycles; the first group, where there is one, is a length
CYCLES = [
    r"(\d+)[\s-]*day\s+cycle",
    r"cycle\s+(?:length|duration)\s*(?:is|of|:)?\s*(\d+)\s*days?",
    r"repeat(?:ed)?\s+every\s+(\d+)\s*(?:days?|weeks?)",
    r"(\d+)[\s-]*week\s+cycle",
    r"(?:21|28|35|42)[\s-]*day\s+(?:treatment\s+)?cycle",
    r"(?:3|4|6)[\s-]*week\s+(?:treatment\s+)?cycle",
    r"cycle\s+\d+\s+day\s+\d+",
    r"c\d+d\d+",
    r"until\s+(?:disease\s+)?progression",
    r"until\s+(?:unacceptable\s+)?toxicity",
    r"until\s+(?:death|withdrawal|discontinuation)",
    r"(?:maximum|up\s+to)\s+(\d+)\s+cycles?",
    r"maintenance\s+(?:phase|therapy)\s+(?:every|q)\s*(\d+)\s*(?:days?|weeks?)",
    r"(?:continue|continued)\s+(?:until|for)\s+(\d+)\s*(?:cycles?|weeks?|months?)",
    r"(?:prime|boost(?:er)?)\s+(?:at|on)\s+(?:day|week)\s+(\d+)",
    r"(?:second|third|booster)\s+(?:dose|vaccination)\s+(?:at|on)",
    r"vaccination\s+(?:at|on)\s+(?:day|week)s?\s+(\d+(?:,\s*\d+)*)",
    r"(?:dialysis|hemodialysis)\s+(?:sessions?|days?)",
    r"(?:3|three)\s+times?\s+(?:per|a)\s+week",
]
#: Words near a cycle that end it, tried in this order
CYCLE_EXITS = {"progression": "Disease progression", "toxicity": "Unacceptable toxicity"}
#: Windows; two groups, where there are two, are the first and the last day
DAY_RANGES = [
    r"day(?:s)?\s*([-–−]?\d+)\s*(?:to|through|[-–−])\s*(?:day\s*)?([-–−]?\d+)",
    r"from\s+day\s*([-–−]?\d+)\s+to\s+day\s*([-–−]?\d+)",
    r"during\s+(?:the\s+)?(\d+)[\s-]*day\s+(?:period|window)",
    r"throughout\s+(?:the\s+)?(?:treatment|study)\s+period",
    r"week(?:s)?\s*(\d+)\s*(?:to|through|[-–])\s*(?:week\s*)?(\d+)",
    r"from\s+week\s*(\d+)\s+to\s+week\s*(\d+)",
    r"(?:screening|washout|run[\-\s]?in)\s+(?:period|window|phase)",
    r"(?:treatment|active|dosing)\s+(?:period|window|phase)",
    r"(?:follow[\-\s]?up|observation|safety)\s+(?:period|window|phase)",
    r"(?:pre|post)[\-\s]?(?:dose|treatment|surgery|procedure)\s+(?:period|window)",
    r"(\d+)\s+(?:days?|hours?)\s+(?:before|after|pre|post)",
    r"(?:in[\-\s]?patient|hospitalization|confinement)\s+(?:period|days?)",
    r"(?:days?\s+)?[-–]?\s*(\d+)\s+to\s+(?:day\s+)?(\d+)\s+(?:in[\-\s]?patient|hospitalized)",
    r"(?:balance|metabolic)\s+(?:period|collection|study)",
    r"(?:24|48|72)[\-\s]?(?:hour|hr)\s+(?:urine|stool|collection)",
    r"washout\s+(?:period|phase)\s+(?:of\s+)?(\d+)\s*(?:days?|weeks?)",
    r"(?:minimum|at\s+least)\s+(\d+)\s*(?:days?|weeks?)\s+washout",
]
#: Collections that are made every day, with their kinds
DAILY_COLLECTIONS = [
    (r"(?:24[\-\s]?hour|daily)\s+urine\s+(?:collection|sample)", "urine_collection"),
    (r"(?:feces|stool|fecal)\s+(?:collection|sample)", "feces_collection"),
    (r"(?:controlled|standardized)\s+(?:meal|diet)", "controlled_meal"),
    (r"daily\s+(?:meal|food)\s+(?:intake|consumption)", "meal_intake"),
    (r"(?:copper|cu|molybdenum|mo)\s+balance", "balance_collection"),
    (r"daily\s+weight", "daily_weight"),
    (r"daily\s+diary", "daily_diary"),
]
#: Fixed value: a range of days near such a collection
NEARBY_RANGE = r"(?:days?\s*)?([-–]?\d+)\s*(?:to|through|[-–])\s*(?:days?\s*)?([-–]?\d+)"
#: Sampling schedules with their kinds. A list of times is numbers with commas between them.
_TIMES = r"(\d+(?:\.\d+)?(?:\s*,\s*\d+(?:\.\d+)?)*)(?:\s*,\s*)?"
SAMPLINGS = [
    (r"(?:PK|pharmacokinetic|blood)\s*(?:sampling|samples?)?\s*(?:at|:)?\s*" + _TIMES + r"\s*(?:min(?:utes?)?|h(?:ours?)?)", "pk"),
    (r"(?:predose|pre-dose|baseline)\s*,?\s*" + _TIMES + r"\s*(?:min(?:utes?)?|h(?:ours?)?)", "pk"),
    (r"(?:sampling|samples?)\s*(?:at)?\s*(?:time)?\s*" + _TIMES + r"\s*(?:h(?:ours?)?|min(?:utes?)?)", "pk"),
    (r"(?:plasma\s+)?glucose\s*(?:sampling|samples?|measurements?)?\s*(?:at|:)?\s*" + _TIMES + r"\s*(?:min(?:utes?)?)", "glucose"),
    (r"(?:PD|pharmacodynamic)\s*(?:sampling|samples?)\s*(?:at|:)?\s*" + _TIMES + r"\s*(?:min(?:utes?)?)", "glucose"),
    (r"glucose\s*(?:measured|collected)\s*(?:at)?\s*(?:times?)?\s*" + _TIMES + r"\s*(?:min(?:utes?)?)", "glucose"),
    (r"minimum\s*(?:of)?\s*(\d+)\s*(?:samples?|observations?|measurements?)", "minimum"),
    (r"at\s*least\s*(\d+)\s*(?:samples?|observations?)\s*(?:per|each)\s*(?:window|period|visit)", "minimum"),
    (r"no\s*fewer\s*than\s*(\d+)\s*(?:samples?|observations?)", "minimum"),
    (r"[≥>=]\s*(\d+)\s*(?:samples?|observations?)\s*(?:required|necessary)", "minimum"),
    (r"intensive\s*(?:PK|pharmacokinetic)?\s*sampling", "dense"),
    (r"dense\s*sampling\s*(?:window|period)?", "dense"),
    (r"serial\s*(?:blood)?\s*sampling", "dense"),
    (r"frequent\s*sampling", "dense"),
    (r"sparse\s*sampling\s*(?:design|approach)?", "sparse"),
    (r"population\s*(?:PK|pharmacokinetic)\s*(?:sampling)?", "sparse"),
    (r"limited\s*sampling", "sparse"),
]
#: Analysis windows named without days, with their kinds
ANALYSIS_MARKS = [
    (r"accumulation\s+(?:period|window|phase)", "accumulation"),
    (r"(?:initial|early)\s+(?:treatment\s+)?(?:period|phase)", "accumulation"),
    (r"steady[\-\s]?state\s+(?:period|window|phase)", "steady_state"),
    (r"(?:maintenance|stable)\s+(?:treatment\s+)?(?:period|phase)", "steady_state"),
    (r"treatment\s+(?:period|window|phase)\s*(?:\d+)?", "treatment"),
    (r"(?:active|dosing)\s+(?:period|phase)", "treatment"),
]
#: Layouts of footnotes with two groups, label and text, and what stands before the label
FOOTNOTE_LAYOUTS = [
    ("letters", r"(?mds)^([a-z])[\.\)]\s+(.+?)(?=^[a-z][\.\)]|\z)", ""),
    ("brackets", r"(?ids)\[([a-z\d]+)\]\s*[:\.]?\s*(.+?)(?=\[[a-z\d]+\]|\n\n|\z)", "["),
    ("superscripts", r"(?ids)[\^ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸᶻ]([a-z])\s*[:\.]?\s*(.+?)(?=[\^ᵃᵇᶜᵈᵉᶠᵍʰⁱʲᵏˡᵐⁿᵒᵖʳˢᵗᵘᵛʷˣʸᶻ][a-z]|\n\n|\z)", "^"),
    ("numbers", r"(?mds)(?:^|\n)(\d{1,2})[\.\)]\s+([A-Z].+?)(?=(?:^|\n)\d{1,2}[\.\)]|\n\n|\z)", ""),
]
#: Sections of footnotes; the group is the section
FOOTNOTE_SECTIONS = [
    r"(?imds)(?:footnotes?|notes?\s+to\s+table|table\s+notes?)\s*[:\-]?\s*\n(.+?)(?=\n\n\n|\z|(?:^[A-Z][A-Z\s]+:))",
    r"(?imds)(?:abbreviations?.*?:?\s*\n)?([a-z]\.\s+.+?)(?=\n\n\n|\z)",
]
#: Analysis windows with their first and last day
ANALYSIS_WINDOWS = {
    "baseline": r"(?:baseline|pre[\-\s]?treatment)\s+(?:period|window|phase|days?)?\s*[:\-]?\s*(?:days?\s*)?([-–−]?\s*\d+)\s*(?:to|through|[-–−])\s*(?:days?\s*)?([-–−]?\s*\d+)",
    "treatment": r"(?:treatment|dosing|active)\s+(?:period|window|phase)?\s*[:\-]?\s*(?:days?\s*)?(\d+)\s*(?:to|through|[-–])\s*(?:days?\s*)?(\d+)",
    "steady_state": r"steady[\-\s]?state\s+(?:period|window|phase|days?)?\s*[:\-]?\s*(?:days?\s*)?(\d+)\s*(?:to|through|[-–])\s*(?:days?\s*)?(\d+)",
}
#: (pattern, class), tried in this order
FOOTNOTES = [
    (r"(\d+)\s*(?:min(?:ute)?s?|hours?)\s+(?:before|prior\s+to)\s+(.+)", "timing_before"), (r"(?:before|prior\s+to)\s+(.+)", "timing_before"),
    (r"(\d+)\s*(?:min(?:ute)?s?|hours?)\s+(?:after|following)\s+(.+)", "timing_after"), (r"(?:after|following)\s+(.+)", "timing_after"),
    (r"(?:at|on)\s+(?:day|week)\s+(\d+)", "timing_at"), (r"(?:at|during)\s+(?:each|every)\s+(?:visit|timepoint)", "timing_recurring"),
    (r"(.+)\s+(?:then|followed\s+by)\s+(.+)", "sequence"),
    (r"(?:for|in)\s+(?:women|female)\s+(?:of\s+)?(?:childbearing|reproductive)\s+(?:potential|age)", "eligibility_wocbp"),
    (r"(?:for|in)\s+(?:patients?|subjects?)\s+(?:with|who\s+have)\s+(.+)", "eligibility_condition"), (r"(?:if|when)\s+(?:applicable|indicated|required)", "eligibility_conditional"),
    (r"(?:for|in)\s+(?:patients?|subjects?)\s+(?:age[d]?\s+)?(\d+)\s*(?:years?|and\s+older)", "eligibility_age"), (r"(?:for|in)\s+(?:patients?|subjects?)\s+(?:with|taking)\s+(.+)", "eligibility_exclusion"),
    (r"(?:performed|collected|measured)\s+(?:in\s+)?(?:triplicate|duplicate)", "procedure_replicate"), (r"(?:triplicate|duplicate)\s+(?:measurements?|readings?|samples?)", "procedure_replicate"),
    (r"(?:at|on|during)\s+(?:weeks?|days?|visits?)\s+([\d,\s]+(?:and\s+\d+)?)", "procedure_timepoints"), (r"(?:if|when)\s+(?:clinically\s+)?(?:indicated|necessary|required)", "procedure_conditional"),
    (r"(?:as\s+)?(?:clinically\s+)?indicated", "procedure_conditional"), (r"(?:fasting|after\s+(?:\d+[\-\s]?hour)?\s*fast)", "procedure_fasting"),
    (r"(?:daily|once\s+daily|every\s+day)", "frequency_daily"), (r"(?:weekly|once\s+(?:a|per)\s+week)", "frequency_weekly"), (r"(?:twice|two\s+times?)\s+(?:daily|per\s+day)", "frequency_bid"),
    (r"(?:during|throughout)\s+(?:the\s+)?(?:treatment|study|dosing)\s+(?:period|phase)", "frequency_continuous"),
]
VISITS = [
    (r"\b(?:Visit|V)\s*(\d+)", "Visit"), (r"(Screening|Baseline|Randomization)\s*(?:Visit)?", ""), (r"Week\s*(\d+)\s*(?:Visit)?", "Week"), (r"Day\s*(\d+)", "Day"),
    (r"Month\s*(\d+)", "Month"), (r"(End\s+of\s+(?:Study|Treatment)|EOS|EOT)", ""), (r"(Follow[\-\s]?up)\s*(?:Visit)?", ""),
]
TRANSITIONS = [
    ("Screening", "Enrolled", "Meets eligibility criteria"), ("Screening", "Discontinued", "Screen failure"), ("Enrolled", "Randomized", "Randomization"),
    ("Enrolled", "Discontinued", "Early withdrawal before randomization"), ("Randomized", "OnTreatment", "First dose administered"), ("Randomized", "Discontinued", "Withdrawal before treatment"),
    ("OnTreatment", "Completed", "Completes treatment period"), ("OnTreatment", "Discontinued", "Discontinues treatment"), ("OnTreatment", "FollowUp", "Enters follow-up"),
    ("OnTreatment", "Death", "Death on treatment"), ("FollowUp", "Completed", "Completes follow-up"), ("FollowUp", "LostToFollowUp", "Lost to follow-up"),
    ("FollowUp", "Withdrawn", "Withdraws during follow-up"), ("FollowUp", "Death", "Death during follow-up"),
    ("Discontinued", "FollowUp", "Safety follow-up after discontinuation"), ("Discontinued", "Completed", "Completes early termination procedures"),
]
STATE_WORDS = {"Screening": "screening", "Enrolled": "enrol", "Randomized": "random", "OnTreatment": "treatment", "Discontinued": "discontinu", "FollowUp": "follow-up", "Completed": "complet", "Death": "death", "LostToFollowUp": "lost to", "Withdrawn": "withdraw"}
PLACEMENT = {
    "objective": "study.versions[0].studyDesigns[0].objectives", "endpoint": "study.versions[0].studyDesigns[0].endpoints", "estimand": "study.versions[0].studyDesigns[0].estimands",
    "epoch": "study.versions[0].studyDesigns[0].epochs", "encounter": "study.versions[0].studyDesigns[0].encounters", "study_intervention": "study.versions[0].studyDesigns[0].studyInterventions",
    "analysis_population": "study.versions[0].studyDesigns[0].analysisPopulations", "narrative_content": "study.versions[0].narrativeContentItems",
    "narrative_content_item": "study.versions[0].narrativeContentItems", "study_amendment": "study.versions[0].amendments", "geographic_scope": "study.versions[0].studyDesigns[0].geographicScopes",
}
NOISE_STARTS = ["page ", "table ", "figure ", "section ", "chapter ", "version ", "protocol ", "confidential", "proprietary", "amendment", "revision", "date:", "sponsor:"]
FOOTNOTE_WORDS = [
    "visit", "day", "week", "hour", "minute", "before", "after", "if", "when", "only", "must", "should", "may", "can", "patient", "subject", "sample", "blood", "urine", "fasting",
    "female", "male", "women", "men", "childbearing", "triplicate", "duplicate", "repeat", "collect", "assess", "perform", "measure", "record", "document", "applicable", "indicated", "required", "optional",
]
PROSE_STARTS = ["the ", "is ", "with ", "of ", "for ", "to ", "and ", "or ", "in ", "on ", "at ", "by ", "from ", "as "]
PROSE_WORDS = ["reconstituted", "lyophilized", "concentration", "administered", "provided", "according to"]
STOP_ONLY = ["the", "is", "with", "of", "for", "to", "and", "or", "in", "on", "at", "by"]
TITRATION = [
    r"dose\s+titration", r"titrat(?:e|ion|ed)\s+(?:to|from)", r"dose\s+escalation", r"escalat(?:e|ion|ed)\s+(?:to|from)", r"starting\s+dose.*?(?:increase|titrate|escalate)",
    r"initial\s+dose.*?(?:increase|titrate|escalate)", r"dose\s+adjustment", r"within[\-\s]?subject\s+(?:dose|titration)", r"single[\-\s]?arm", r"open[\-\s]?label(?:\s+single)",
    r"all\s+(?:subjects?|participants?)\s+(?:will\s+)?receive", r"no\s+(?:control|placebo|comparator)\s+(?:arm|group)",
]
OBJECTIVE_LEVELS = {"primary": "C85826", "secondary": "C85827", "exploratory": "C163559"}
ENDPOINT_LEVELS = {"primary": "C98772", "secondary": "C98781", "exploratory": "C98724"}
PHASES = {
    "phase 1": "C15600", "phase i": "C15600", "phase 2": "C15601", "phase ii": "C15601", "phase 3": "C15602", "phase iii": "C15602", "phase 4": "C15603", "phase iv": "C15603",
    "phase 1/2": "C15693", "phase i/ii": "C15693", "phase 2/3": "C15694", "phase ii/iii": "C15694",
}
BLINDING_CODES = {
    "open label": "C49659", "open-label": "C49659", "single blind": "C28233", "single-blind": "C28233", "double blind": "C15228", "double-blind": "C15228", "triple blind": "C66959", "triple-blind": "C66959",
}
