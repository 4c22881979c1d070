"""Column lists of the landing tables and the header names of the extracts."""

from __future__ import annotations

# Header of the student extract -> our column.
STUDENT_HEADERS = {
    "PERIODO": "term",
    "NRC": "section",
    "LISTA_CRUZADA": "crosslist",
    "ID_ESTUDIANTE": "student_id",
    "TIPO_DOCUMENTO": "doc_type",
    "DOCUMENTO": "doc_no",
    "CORREO_ESTUDIANTE": "email",
    "NOMBRE_ESTUDIANTE": "first_name",
    "APELLIDO_ESTUDIANTE": "last_name",
    "COD_INSCRIPCIÓN": "enrol_code",
    "ESTADO_INSCRIPCIÓN": "status",
    "FECHA_ACTIVIDAD_EST": "activity_ts",
    "PAGO": "paid",
    "SOCIO_INTEGRADOR": "partner",
}

# Needed by the cost-centre bridge only.
BRIDGE_HEADERS = {
    "PERIODO": "term",
    "LISTA_CRUZADA": "crosslist",
    "ESTADO_INSCRIPCIÓN": "status",
    "COD_PROGRAMA_ESTUDIANTE": "program_code",
}

# Header of the teacher extract -> our column.
TEACHER_HEADERS = {
    "PERIODO": "term",
    "NRC": "section",
    "LISTA_CRUZADA": "crosslist",
    "ID_DOCENTE": "teacher_id",
    "TIPO_DOCUMENTO": "doc_type",
    "DOCUMENTO": "doc_no",
    "CORREO_DOCENTE": "email",
    "NOMBRE_DOCENTE": "first_name",
    "APELLIDO_DOCENTE": "last_name",
    "FECHA_ACTIVIDAD_DOC": "activity_ts",
}

# Header of the user directory -> our column.
USER_HEADERS = {
    "UserName": "user_name",
    "FirstName": "first_name",
    "LastName": "last_name",
    "OrgRoleId": "org_role_id",
    "OrgDefinedId": "org_defined_id",
    "ExternalEmail": "external_email",
}

# Headers of the coordinator directory -> our column.
COORDINATOR_HEADERS = {"Centro de Costos": "cost_centre", "ID COORDINADOR": "coordinator_id"}
COORDINATOR_OPTIONAL_HEADERS = {
    "Coordinador(a)": "coordinator_name",
    "Correo Electrónico": "coordinator_email",
}

# Fixed value: header of the course link list.
LINK_HEADER = "Enlace curso"

LINEAGE = ("src_file", "row_no")

COURSE_COLUMNS = ("short_name", "nrc", "term")
STUDENT_COLUMNS = tuple(STUDENT_HEADERS.values())
TEACHER_COLUMNS = tuple(TEACHER_HEADERS.values())
USER_COLUMNS = tuple(USER_HEADERS.values())
COORDINATOR_COLUMNS = (*COORDINATOR_HEADERS.values(), *COORDINATOR_OPTIONAL_HEADERS.values())

# "First" row of a key: lineage, then the columns that can still differ.
STUDENT_ORDER = (*LINEAGE, "crosslist", "activity_ts", "status", "paid", "doc_no", "email")
TEACHER_ORDER = (*LINEAGE, "crosslist", "activity_ts", "doc_no", "email", "first_name")

COMMAND_COLUMNS = (
    "short_name",
    "nrc",
    "phase",
    "src_file",
    "row_no",
    "section",
    "step",
    "verb",
    "user_id",
    "doc_label",
    "first_name",
    "last_name",
    "role",
    "org_unit",
    "active",
    "email",
)

# Order of lines inside one course list, and of the lists in the consolidated one.
LIST_ORDER = ("phase", "src_file", "row_no", "section", "user_id", "step")
COMMAND_ORDER = ("short_name", "nrc", *LIST_ORDER)
