"""Declared all-text column lists for the two clinical record types.

Fixed values: these names must equal the target tables' column names
exactly, so they are stated as given, in their given order.
"""

# The 50 columns of the patient flat (explode layout, prefix
# "Patient", separator "_").
PATIENT_COLUMNS = [
    "Patient_address_city",
    "Patient_address_country",
    "Patient_address_extension_extension_url",
    "Patient_address_extension_extension_valueDecimal",
    "Patient_address_extension_url",
    "Patient_address_line",
    "Patient_address_postalCode",
    "Patient_address_state",
    "Patient_birthDate",
    "Patient_communication_language_coding_code",
    "Patient_communication_language_coding_display",
    "Patient_communication_language_coding_system",
    "Patient_communication_language_text",
    "Patient_deceasedDateTime",
    "Patient_extension_extension_url",
    "Patient_extension_extension_valueCoding_code",
    "Patient_extension_extension_valueCoding_display",
    "Patient_extension_extension_valueCoding_system",
    "Patient_extension_extension_valueString",
    "Patient_extension_url",
    "Patient_extension_valueAddress_city",
    "Patient_extension_valueAddress_country",
    "Patient_extension_valueAddress_state",
    "Patient_extension_valueCode",
    "Patient_extension_valueDecimal",
    "Patient_extension_valueString",
    "Patient_gender",
    "Patient_id",
    "Patient_identifier_system",
    "Patient_identifier_type_coding_code",
    "Patient_identifier_type_coding_display",
    "Patient_identifier_type_coding_system",
    "Patient_identifier_type_text",
    "Patient_identifier_value",
    "Patient_maritalStatus_coding_code",
    "Patient_maritalStatus_coding_display",
    "Patient_maritalStatus_coding_system",
    "Patient_maritalStatus_text",
    "Patient_meta_profile",
    "Patient_multipleBirthBoolean",
    "Patient_name_family",
    "Patient_name_given",
    "Patient_name_prefix",
    "Patient_name_use",
    "Patient_resourceType",
    "Patient_telecom_system",
    "Patient_telecom_use",
    "Patient_telecom_value",
    "Patient_text_div",
    "Patient_text_status",
]

# The 29 columns of the encounter flat (indexed layout,
# separator "."). The last name is given with a stray trailing comma in the
# original declaration; the intended name ``type.0.text`` is used here.
ENCOUNTER_COLUMNS = [
    "class.code",
    "class.system",
    "id",
    "identifier.0.system",
    "identifier.0.use",
    "identifier.0.value",
    "location.0.location.display",
    "location.0.location.reference",
    "meta.profile.0",
    "participant.0.individual.display",
    "participant.0.individual.reference",
    "participant.0.period.end",
    "participant.0.period.start",
    "participant.0.type.0.coding.0.code",
    "participant.0.type.0.coding.0.display",
    "participant.0.type.0.coding.0.system",
    "participant.0.type.0.text",
    "period.end",
    "period.start",
    "resourceType",
    "serviceProvider.display",
    "serviceProvider.reference",
    "status",
    "subject.display",
    "subject.reference",
    "type.0.coding.0.code",
    "type.0.coding.0.display",
    "type.0.coding.0.system",
    "type.0.text",
]

# The three columns loaded into the SQL target table.
SQL_TARGET_COLUMNS = ["class.code", "class.system", "id"]
