"""Fixed values of public corpora: their labels' classes, tags and predicates, which results depend on."""

from __future__ import annotations

# Classes of labels, by corpus; keys in lower case.
GLINER_BIOMED_POST = {
    "person": "Agent",
    "politician": "Agent",
    "athlete": "Agent",
    "author": "Agent",
    "organization": "Agent",
    "medical condition": "Disease",
    "tumor type": "Disease",
    "location": "GeographicLocation",
    "city": "GeographicLocation",
}

PILE_NER_BIOMED = {
    "medical condition": "Disease",
    "disorder": "Disease",
    "health condition": "Disease",
    "chemical": "ChemicalEntity",
    "compound": "ChemicalEntity",
    "substance": "ChemicalEntity",
    "chemical compound": "ChemicalEntity",
    "chemical substance": "ChemicalEntity",
    "medication": "Drug",
    "gene/protein": "Gene",
    "enzyme": "Protein",
    "cell": "Cell",
    "cell line": "CellLine",
    "anatomical structure": "GrossAnatomicalStructure",
    "anatomical entity": "AnatomicalEntity",
    "body part": "GrossAnatomicalStructure",
    "organ": "GrossAnatomicalStructure",
    "anatomy": "GrossAnatomicalStructure",
    "tissue": "AnatomicalEntity",
    "organism": "OrganismTaxon",
    "species": "OrganismTaxon",
    "animal": "OrganismTaxon",
    "bacteria": "Bacterium",
    "virus": "Virus",
    "process": "BiologicalProcess",
    "sign or symptom": "PhenotypicFeature",
    "treatment": "Treatment",
    "medical treatment": "Treatment",
    "therapy": "Treatment",
    "medical procedure": "Procedure",
    "procedure": "Procedure",
    "medical test": "DiagnosticAid",
    "test": "DiagnosticAid",
    "medical device": "Device",
    "device": "Device",
    "instrument": "Device",
    "medical equipment": "Device",
    "measurement": "ClinicalMeasurement",
    "medical measurement": "ClinicalMeasurement",
    "quantity": "ClinicalMeasurement",
    "food": "Food",
    "nutrient": "Food",
    "publication": "Publication",
    "study": "Study",
    "location": "GeographicLocation",
    "country": "GeographicLocation",
    "city": "GeographicLocation",
    "organization": "Agent",
    "person": "Human",
    "patient": "Human",
    "group": "PopulationOfIndividualOrganisms",
    "population": "PopulationOfIndividualOrganisms",
    "cohort": "Cohort",
    "mutation": "SequenceVariant",
    "genetic variation": "SequenceVariant",
}

PILE_NER_TYPE = {
    "person": "Human",
    "organization": "Agent",
    "company": "Agent",
    "group": "PopulationOfIndividualOrganisms",
    "location": "GeographicLocation",
    "country": "GeographicLocation",
    "city": "GeographicLocation",
    "state": "GeographicLocation",
    "date": "Attribute",
    "time": "Attribute",
    "quantity": "Attribute",
    "event": "Event",
    "software": "InformationContentEntity",
    "technology": "InformationContentEntity",
    "website": "InformationContentEntity",
    "programming language": "InformationContentEntity",
    "disease": "Disease",
    "medical condition": "Disease",
    "condition": "Disease",
    "symptom": "PhenotypicFeature",
    "drug": "Drug",
    "medication": "Drug",
    "treatment": "Treatment",
    "medical treatment": "Treatment",
    "procedure": "Procedure",
    "medical procedure": "Procedure",
    "measurement": "ClinicalMeasurement",
    "chemical": "ChemicalEntity",
    "compound": "ChemicalEntity",
    "chemical compound": "ChemicalEntity",
    "substance": "ChemicalEntity",
    "protein": "Protein",
    "enzyme": "Protein",
    "gene": "Gene",
    "cell": "Cell",
    "cell type": "Cell",
    "cell line": "CellLine",
    "organism": "OrganismTaxon",
    "species": "OrganismTaxon",
    "animal": "OrganismTaxon",
    "anatomical structure": "GrossAnatomicalStructure",
    "body part": "GrossAnatomicalStructure",
    "organ": "GrossAnatomicalStructure",
    "food": "Food",
    "publication": "Publication",
    "book": "Publication",
    "study": "Study",
    "mutation": "SequenceVariant",
    "genetic variation": "SequenceVariant",
}

KNOWLEDGATOR_BIOMED = {
    "chemicals": "ChemicalEntity",
    "clinical drug": "Drug",
    "body substance": "AnatomicalEntity",
    "anatomical structure": "GrossAnatomicalStructure",
    "cells and their components": "Cell",
    "gene and gene products": "Gene",
    "genes": "Gene",
    "intellectual property": "Patent",
    "geographical areas": "GeographicLocation",
    "location": "GeographicLocation",
    "locations": "GeographicLocation",
    "organism": "OrganismTaxon",
    "organisms": "OrganismTaxon",
    "group": "PopulationOfIndividualOrganisms",
    "person": "Human",
    "organization": "Agent",
    "organizations": "Agent",
    "product": "Device",
    "products": "Device",
    "phenotype": "PhenotypicFeature",
    "findings/phenotypes": "PhenotypicFeature",
    "disorder": "Disease",
    "disorders": "Disease",
    "signaling molecules": "MolecularEntity",
    "event": "Event",
    "events": "Event",
    "medical procedure": "Procedure",
    "activity": "Activity",
    "function": "BiologicalProcess",
}

GLINER_MULTILINGUAL = {
    "person": "Human",
    "personne": "Human",
    "persona": "Human",
    "pessoa": "Human",
    "osoba": "Human",
    "osobnik": "Human",
    "location": "GeographicLocation",
    "lieu": "GeographicLocation",
    "luogo": "GeographicLocation",
    "ort": "GeographicLocation",
    "lugar": "GeographicLocation",
    "local": "GeographicLocation",
    "locatie": "GeographicLocation",
    "miejsce": "GeographicLocation",
    "país": "GeographicLocation",
    "organization": "Agent",
    "organisation": "Agent",
    "organización": "Agent",
    "organização": "Agent",
    "disease": "Disease",
    "enfermedad": "Disease",
    "malattia": "Disease",
    "maladie": "Disease",
    "krankheit": "Disease",
    "choroba": "Disease",
    "drug": "Drug",
    "medication": "Drug",
    "medicamento": "Drug",
    "medicament": "Drug",
    "arzneimittel": "Drug",
    "lekarstwo": "Drug",
    "food": "Food",
    "alimento": "Food",
    "lebensmittel": "Food",
    "jedzenie": "Food",
    "nourriture": "Food",
    "plant": "Plant",
    "plante": "Plant",
    "pflanze": "Plant",
    "roślina": "Plant",
    "planta": "Plant",
    "animal": "OrganismTaxon",
    "animale": "OrganismTaxon",
    "tier": "OrganismTaxon",
    "zwierzę": "OrganismTaxon",
}

MED_MENTIONS = {
    "T005": "Virus",
    "T007": "Bacterium",
    "T017": "AnatomicalEntity",
    "T022": "AnatomicalEntity",
    "T031": "AnatomicalEntity",
    "T033": "ClinicalFinding",
    "T037": "Disease",
    "T038": "BiologicalProcess",
    "T058": "ClinicalIntervention",
    "T062": "Study",
    "T074": "Device",
    "T082": "GeographicLocation",
    "T091": "Activity",
    "T092": "Agent",
    "T097": "PopulationOfIndividualOrganisms",
    "T098": "PopulationOfIndividualOrganisms",
    "T103": "ChemicalEntity",
    "T168": "Food",
    "T170": "InformationContentEntity",
    "T201": "ClinicalAttribute",
    "T204": "OrganismTaxon",
}

NEMOTRON_PII = {
    "first_name": "Human",
    "last_name": "Human",
    "occupation": "SocioeconomicAttribute",
    "education_level": "SocioeconomicAttribute",
    "employment_status": "SocioeconomicAttribute",
    "gender": "BiologicalSex",
    "country": "GeographicLocation",
    "city": "GeographicLocation",
    "state": "GeographicLocation",
    "county": "GeographicLocation",
    "street_address": "GeographicLocation",
    "postcode": "GeographicLocation",
    "coordinate": "GeographicLocation",
    "company_name": "Agent",
}

JNLPBA = {
    "chemical": "ChemicalEntity",
    "gene": "Gene",
    "protein": "Protein",
    "disease": "Disease",
    "dna": "NucleicAcidEntity",
    "rna": "NucleicAcidEntity",
    "cell_line": "CellLine",
    "cell_type": "Cell",
    "species": "OrganismTaxon",
}

BIORED = {
    "cellline": "CellLine",
    "chemicalentity": "ChemicalEntity",
    "diseaseorphenotypicfeature": "DiseaseOrPhenotypicFeature",
    "geneorgeneproduct": "Gene",
    "organismtaxon": "OrganismTaxon",
    "sequencevariant": "SequenceVariant",
}

CHIA = {
    "condition": "DiseaseOrPhenotypicFeature",
    "drug": "Drug",
    "procedure": "Procedure",
    "person": "Human",
    "device": "Device",
    "measurement": "ClinicalMeasurement",
    "observation": "ClinicalFinding",
    "qualifier": "ClinicalModifier",
}

BIOLEAFLETS = {
    "dx_name": "Disease",
    "problem": "Disease",
    "generic_name": "Drug",
    "brand_name": "Drug",
    "procedure_name": "Procedure",
    "test_name": "ClinicalMeasurement",
    "test": "ClinicalMeasurement",
    "treatment_name": "Treatment",
    "treatment": "Treatment",
    "system_organ_site": "AnatomicalEntity",
}

DOCRED = {
    "per": "Human",
    "org": "Agent",
    "loc": "GeographicLocation",
    "misc": "NamedThing",
}

# Tag names by class number.
JNLPBA_TAGS = (
    "O",
    "B-GENE", "I-GENE",
    "B-CHEMICAL", "I-CHEMICAL",
    "B-DISEASE", "I-DISEASE",
    "B-DNA", "I-DNA",
    "B-RNA", "I-RNA",
    "B-CELL_LINE", "I-CELL_LINE",
    "B-CELL_TYPE", "I-CELL_TYPE",
    "B-PROTEIN", "I-PROTEIN",
    "B-SPECIES", "I-SPECIES",
)

# Predicates of relation types, by corpus.
CHEMPROT_PREDICATES = {
    "CPR:1": "part_of",
    "CPR:2": "regulates",
    "CPR:3": "increases_amount_or_activity_of",
    "CPR:4": "decreases_amount_or_activity_of",
    "CPR:5": "increases_amount_or_activity_of",
    "CPR:6": "decreases_amount_or_activity_of",
    "CPR:7": "modulator",
    "CPR:8": "cofactor",
    "CPR:9": "is_substrate_of",
}

DRUGPROT_PREDICATES = {
    "ACTIVATOR": "increases_amount_or_activity_of",
    "AGONIST": "agonist",
    "AGONIST-ACTIVATOR": "agonist_activator",
    "AGONIST-INHIBITOR": "agonist_inhibitor",
    "ANTAGONIST": "antagonist",
    "DIRECT-REGULATOR": "regulates",
    "INDIRECT-DOWNREGULATOR": "decreases_amount_or_activity_of",
    "INDIRECT-UPREGULATOR": "increases_amount_or_activity_of",
    "INHIBITOR": "decreases_amount_or_activity_of",
    "PART-OF": "part_of",
    "PRODUCT-OF": "product_of",
    "SUBSTRATE": "is_substrate_of",
    "SUBSTRATE_PRODUCT-OF": "substrate_product_of",
}

BIORED_PREDICATES = {
    "Association": "associated_with",
    "Positive_Correlation": "positively_correlated_with",
    "Negative_Correlation": "negatively_correlated_with",
    "Bind": "physically_interacts_with",
    "Drug_Interaction": "pharmacologically_interacts_with",
    "Comparison": "comparison",
    "Cotreatment": "cotreatment",
    "Conversion": "conversion",
}

CHIA_PREDICATES = {"subsumes": "superclass_of", "has_temporal": "temporally_related_to"}
#: Types that join criteria and state no relation.
CHIA_INTEGRATORS = ("and", "or")

# English names of a document-relation corpus's 96 property ids.
DOCRED_NAMES = {
    "P1001": "applies to jurisdiction",
    "P102": "member of political party",
    "P1056": "product or material produced",
    "P108": "employer",
    "P112": "founded by",
    "P118": "league",
    "P1198": "unemployment rate",
    "P123": "publisher",
    "P127": "owned by",
    "P131": "located in the administrative territorial entity",
    "P1336": "territory claimed by",
    "P1344": "participant of",
    "P136": "genre",
    "P1365": "replaces",
    "P1366": "replaced by",
    "P137": "operator",
    "P1376": "capital of",
    "P140": "religion",
    "P1412": "languages spoken, written or signed",
    "P1441": "present in work",
    "P150": "contains administrative territorial entity",
    "P155": "follows",
    "P156": "followed by",
    "P159": "headquarters location",
    "P161": "cast member",
    "P162": "producer",
    "P166": "award received",
    "P17": "country",
    "P170": "creator",
    "P171": "parent taxon",
    "P172": "ethnic group",
    "P175": "performer",
    "P176": "manufacturer",
    "P178": "developer",
    "P179": "series",
    "P19": "place of birth",
    "P190": "sister city",
    "P194": "legislative body",
    "P20": "place of death",
    "P205": "basin country",
    "P206": "located in or next to body of water",
    "P22": "father",
    "P241": "military branch",
    "P25": "mother",
    "P26": "spouse",
    "P264": "record label",
    "P27": "country of citizenship",
    "P272": "production company",
    "P276": "location",
    "P279": "subclass of",
    "P30": "continent",
    "P31": "instance of",
    "P3373": "sibling",
    "P35": "head of state",
    "P355": "subsidiary",
    "P36": "capital",
    "P361": "part of",
    "P364": "original language of work",
    "P37": "official language",
    "P39": "position held",
    "P40": "child",
    "P400": "platform",
    "P403": "mouth of the watercourse",
    "P449": "original network",
    "P463": "member of",
    "P488": "chairperson",
    "P495": "country of origin",
    "P50": "author",
    "P527": "has part",
    "P54": "member of sports team",
    "P551": "residence",
    "P569": "date of birth",
    "P57": "director",
    "P570": "date of death",
    "P571": "inception",
    "P576": "dissolved, abolished or demolished",
    "P577": "publication date",
    "P58": "screenwriter",
    "P580": "start time",
    "P582": "end time",
    "P585": "point in time",
    "P6": "head of government",
    "P607": "conflict",
    "P674": "characters",
    "P676": "lyrics by",
    "P69": "educated at",
    "P706": "located on terrain feature",
    "P710": "participant",
    "P737": "influenced by",
    "P740": "location of formation",
    "P749": "parent organization",
    "P800": "notable work",
    "P807": "separated from",
    "P840": "narrative location",
    "P86": "composer",
    "P937": "work location",
}

# Of an extraction corpus, the source and path of leaves that name something, and its class.
JSON_LEAVES = (
    ("owkin/medical_knowledge_from_extracts", "conditions[]", "Disease"),
    ("owkin/medical_knowledge_from_extracts", "interventions[].name", "ChemicalEntity"),
    ("roborovski/dolly-entity-extraction", "name", "Agent"),
    ("roborovski/dolly-entity-extraction", "result.name", "Agent"),
    ("roborovski/dolly-entity-extraction", "result.properties.name", "Agent"),
    ("roborovski/dolly-entity-extraction", "results[].name", "Agent"),
    ("roborovski/dolly-entity-extraction", "results[].properties.name", "Agent"),
    ("sandeeppanem/resume-json-extraction-5k", "current_company", "Agent"),
    ("sandeeppanem/resume-json-extraction-5k", "previous_companies[]", "Agent"),
    ("Jiraya/html_to_json_information_extraction_dataset", "[].Job Location", "GeographicLocation"),
)
#: Names of interventions count beside one of these types, other names beside this entity.
JSON_INTERVENTIONS = "owkin/medical_knowledge_from_extracts"
JSON_INTERVENTION_TYPES = ("drug", "biological", "dietary supplement", "genetic")
JSON_PERSONS = "roborovski/dolly-entity-extraction"
JSON_PERSON = "Person"
#: Companies that begin so are placeholders.
JSON_COMPANIES = "sandeeppanem/resume-json-extraction-5k"
JSON_PLACEHOLDER = "Company Name"
#: The source whose items are (subject, predicate, object), and the predicates that count.
JSON_TRIPLES = "ProfessorBob/relation_extraction"
JSON_PREDICATES = {"member of": "member_of"}
