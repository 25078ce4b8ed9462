"""Rule tables that turn a source vocabulary into the standard service hierarchy."""

from __future__ import annotations

from dataclasses import dataclass

CLINICAL = "Clinical Services"
MATERNAL = "Reproductive & Maternal Health"
HIV = "HIV/AIDS Services"
MALARIA = "Malaria Services"
DIAGNOSTIC = "Diagnostic Services"
COMMUNITY = "Community & Preventive Health"
SUPPORT = "Support Services"


@dataclass(frozen=True)
class CategoryRule:
    category: str
    domain: str
    group: str
    is_clinical: bool
    include_in_analysis: bool
    is_malaria_related: bool = False


@dataclass(frozen=True)
class NameRule:
    pattern: str
    domain: str
    group: str


# Ownership classes, first matching pattern wins, else "Other".
OWNERSHIP_RULES = (
    ("public|government|lga|moh|military|police|prison|parastatal", "Public"),
    ("faith|fbo|church|mission|religious|ngo", "Faith-Based / NGO"),
    ("private|profit|company|investor|business|clinic", "Private"),
)
OWNERSHIP_DEFAULT = "Other"

# Keyword patterns for the flags.
MALARIA_NAME = "malaria|mrdt"
MALARIA_DETAIL = "malaria|mrdt|rdt for malaria|act "
REVIEW_NAME = "^error|^others$"
MALARIA_GROUP = "Malaria Diagnosis and Treatment"

# Attributes of a name no pattern matches, by source category.
CATEGORY_DEFAULTS = (
    CategoryRule("clinical_services", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("diagnostic_services", DIAGNOSTIC, "Diagnostic Services", True, True),
    CategoryRule("support_services", SUPPORT, "Support Services", False, False),
    CategoryRule("twenty_four_hour", SUPPORT, "Service Hours", False, False),
)

# Name patterns in order of precedence, matched anywhere in the name.
NAME_RULES = (
    NameRule(r"^anc\b|antenatal|^pnc\b|post.?partum|postnatal",
             MATERNAL, "Reproductive & Maternal Health Services"),
    NameRule(r"delivery|cemoc|obstetric|maternal\s?health|maternity|newborn|neonatal|essential new born",
             MATERNAL, "Reproductive & Maternal Health Services"),
    NameRule(r"family planning|pregnancy planning|pre conception",
             MATERNAL, "Family Planning"),
    NameRule(r"abortion", MATERNAL, "Reproductive & Maternal Health Services"),
    NameRule(r"adolescent|youth", MATERNAL, "Reproductive & Maternal Health Services"),
    NameRule(r"cervical cancer", MATERNAL, "Reproductive & Maternal Health Services"),
    NameRule(r"mch\b|reproductive, maternal", MATERNAL, "Reproductive & Maternal Health Services"),
    NameRule(r"hiv|aids|viral load|cd4 count|prep|art\b", HIV, "HIV/AIDS Services"),
    NameRule(r"\btb\b|tuberculosis|afb stain", CLINICAL, "TB Services"),
    NameRule(r"malaria|mrdt", MALARIA, "Malaria Diagnosis and Treatment"),
    NameRule(r"immuniz|immunis|vaccin", COMMUNITY, "Immunisation/Vaccination"),
    NameRule(r"imnci|iccm|growth monitor|otp\b|outpatient therapeutic|sick baby|under five|malnutrition|imci",
             COMMUNITY, "Growth Monitoring & Nutrition"),
    NameRule(r"health promotion|healthy living|infant feeding|community.based|venerology|sti\b|ntd\b",
             COMMUNITY, "Health Promotion and Disease Prevention"),
    NameRule(r"pharma|medicine preparation|compounding", SUPPORT, "Therapeutics and Pharmacy"),
    NameRule(r"surger|surgical|anesth|anaesth|exodontia|chemotherapy|lithotripsy|transplant|interventional"
             r"|endoscop|stent|cathet|colonoscop|urethroscop",
             CLINICAL, "Surgical Services"),
    NameRule(r"emergency|first aid|ambulance|24 hours emergency|24 hours ambulance|cardiac emergency"
             r"|emergency gynec|emergency nephr|emergency oral",
             CLINICAL, "Emergency Services"),
    NameRule(r"icu|inpatient|admission|nicu|cardiac icu|recovery", CLINICAL, "General Inpatient (IPD)"),
    NameRule(r"ent\b|orl\b|dental|dentistr|eye|ophthalm|optometry|visual|slit lamp|keratometry|colour test",
             CLINICAL, "ENT Services"),
    NameRule(r"mental|psychiatr|psycholog|ect\b|substance abuse|drug dependency",
             CLINICAL, "General Clinical Services"),
    NameRule(r"x.?ray|ultrasound|mri|magnetic resonance|computer tomograph|\bct\b|fluoroscop|mammograph"
             r"|nuclear medicine|echocardiograph|radio|imaging",
             DIAGNOSTIC, "Radiology Services"),
    NameRule(r"bacteriolog|microbiolog|mycolog|fungal culture|parasitolog|virolog|serolog|hematolog|haematolog"
             r"|chemistr|coagulation|cd4|viral load|biochem|fertility tests|liver function|renal function"
             r"|lipid profile|thyroid|cytology|pathology|biopsy|histo|electrolyte|electrophoresis|reticulocyte"
             r"|semen|tumor markers|gram stain|esr|coomb|drug test|allergy|covid|diabetic tests"
             r"|peripheral morphology",
             DIAGNOSTIC, "Laboratory Services"),
    NameRule(r"blood transfus|blood group|24 hours blood", DIAGNOSTIC, "Diagnostic Services"),
    NameRule(r"physiotherap|physical therapy|recreational therapy|vocational rehab|rehabil"
             r"|occupational therapy|speech therapy",
             CLINICAL, "General Clinical Services"),
    NameRule(r"dermatolog|oncolog|skin|cancer|radiotherapy|brach therapy|laser therapy",
             CLINICAL, "General Clinical Services"),
    NameRule(r"stress testing|electro.cautery|nerve conduction|electro encephal|eeg",
             DIAGNOSTIC, "Diagnostic Services"),
    NameRule(r"morgue|autopsy|care after death", SUPPORT, "Support Services"),
    NameRule(r"24 hours|24 hour ", SUPPORT, "Service Hours"),
    NameRule(r"waste management|infection prevention|housekeep|laundry|food and diary|social work",
             SUPPORT, "Support Services"),
    NameRule(r"^error$|^others$", SUPPORT, "Support Services"),
)

# Exact source categories (verbatim, capitals as in the source).
CATEGORY_RULES = (
    CategoryRule("ACCIDENT AND EMERGENCY CASUALTY SERVICES", CLINICAL, "Emergency Services", True, True),
    CategoryRule("AMBULATORY SERVICES", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("ANTENATAL CARE", MATERNAL, "Reproductive & Maternal Health Services", True, True),
    CategoryRule("BLOOD SERVICES", DIAGNOSTIC, "Diagnostic Services", True, True),
    CategoryRule("CANCER SCREENING", DIAGNOSTIC, "Diagnostic Services", True, True),
    CategoryRule("CENTRAL STERILE SERVICES DEPARTMENT", SUPPORT, "Equipment and Infrastructure", False, False),
    CategoryRule("CURATIVE SERVICES", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("DENTAL SERVICES", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("EMERGENCY PREPAREDNESS", CLINICAL, "Emergency Services", True, True),
    CategoryRule("FAMILY PLANNING", MATERNAL, "Family Planning", True, True),
    CategoryRule("FORENSIC SERVICES", COMMUNITY, "Health Promotion and Disease Prevention", False, False),
    CategoryRule("HIGH DEPENDENCY SERVICES", CLINICAL, "General Inpatient (IPD)", True, True),
    CategoryRule("HIV TREATMENT", HIV, "HIV/AIDS Care and Treatment", True, True),
    CategoryRule("HIV/AIDS PREVENTION AND CARE SERVICES", HIV, "HIV/AIDS Services", True, True),
    CategoryRule("HIV/AIDS TREATMENT SERVICES", HIV, "HIV/AIDS Care and Treatment", True, True),
    CategoryRule("HOSPICE SERVICE", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("ICU SERVICES", CLINICAL, "General Inpatient (IPD)", True, True),
    CategoryRule("IMMUNISATION", COMMUNITY, "Immunisation/Vaccination", True, True),
    CategoryRule("INPATIENT SERVICES", CLINICAL, "General Inpatient (IPD)", True, True),
    CategoryRule("INTEGRATED MANAGEMENT OF CHILDHOOD ILLNESS", COMMUNITY, "Growth Monitoring & Nutrition", True, True),
    CategoryRule("INTERGRATED IMMUNIZATION", COMMUNITY, "Immunisation/Vaccination", True, True),
    CategoryRule("LABORATORY SERVICES", DIAGNOSTIC, "Diagnostic Services", True, True),
    CategoryRule("LEPROSY DIAGNOSIS", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("LEPROSY TREATMENT", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("MATERNITY SERVICES", MATERNAL, "Reproductive & Maternal Health Services", True, True),
    CategoryRule("MENTAL HEALTH SERVICES", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("MORTUARY SERVICES", SUPPORT, "Support Services", False, False),
    CategoryRule("NEWBORN CARE SERVICE", MATERNAL, "Reproductive & Maternal Health Services", True, True),
    CategoryRule("NHIF ACCREDITATION STATUS", SUPPORT, "Support Services", False, False),
    CategoryRule("NUTRITION SERVICES", COMMUNITY, "Growth Monitoring & Nutrition", True, True),
    CategoryRule("OCCUPATIONAL THERAPY", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("ONCOLOGY SERVICES", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("OPHTHALMIC SERVICES", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("OPHTHALMIC SERVICES1", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("ORGAN TRANSPLANT", CLINICAL, "Surgical Services", True, True),
    CategoryRule("ORTHOPAEDIC TECHNOLOGY SERVICES", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("PHARMACY SERVICES", SUPPORT, "Therapeutics and Pharmacy", False, False),
    CategoryRule("PHYSIO THERAPY", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("POSTNATAL CARE SERVICES", MATERNAL, "Reproductive & Maternal Health Services", True, True),
    CategoryRule("RADIOLOGY AND IMAGING", DIAGNOSTIC, "Radiology Services", True, True),
    CategoryRule("REHABILITATION SERVICES", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("RENAL SERVICES", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("SERVICES FOR GENDER BASED VIOLENCE SURVIVORS", COMMUNITY, "Health Promotion and Disease Prevention", True, True),
    CategoryRule("SPECIALIZED IN-PATIENT SERVICES", CLINICAL, "General Inpatient (IPD)", True, True),
    CategoryRule("SPECIALIZED OUTPATIENTS CLINIC", CLINICAL, "General Clinical Services", True, True),
    CategoryRule("STAND ALONE FACILITY REGULATION", SUPPORT, "Support Services", False, False),
    CategoryRule("THEATRE SERVICES", CLINICAL, "Surgical Services", True, True),
    CategoryRule("TUBERCULOSIS DIAGNOSIS", CLINICAL, "TB Services", True, True),
    CategoryRule("TUBERCULOSIS TREATMENTS", CLINICAL, "TB Services", True, True),
    CategoryRule("YOUTH FRIENDLY SERVICES", COMMUNITY, "Health Promotion and Disease Prevention", True, True),
)
