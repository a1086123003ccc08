"""Column names, struct types and wire constants shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the wire format.
SCHEMA_VERSION = "1.0"
SOURCE_CSV = "powercard-csv"
SOURCE_CDC = "postgresql-cdc"
CANONICAL_SCHEMA = "rt-payments-canonical-v1"
TOPIC_SEALED = "payments"
TOPIC_CDC = "cdc.public.powercard_operations"
TOPIC_DECRYPTED = "payments.decrypted"
TOPIC_VALIDATED = "payments.validated"
TOPIC_NORMALIZED = "payments.normalized"
TOPIC_DLQ = "payments.dlq"

# The topics whose message counts the status report lists, in its order.
STATUS_TOPICS = (TOPIC_CDC, TOPIC_DECRYPTED, TOPIC_VALIDATED, TOPIC_NORMALIZED, TOPIC_DLQ)

# Text columns of the operations table, in table order.
OPERATION_COLUMNS = tuple("""
message_type function_code processing_code action_code original_action_code issuer_action_code
event_code network_code issuing_bank transaction_local_date transmission_date_and_time
response_date_and_time internal_transmission_time capture_date business_date product_code card_type
transaction_amount cash_back_amount transaction_currency replacement_amount billing_amount
billing_currency conversion_rate conversion_rate_date iss_settlement_amount iss_settlement_currency
iss_settlement_date iss_conv_rate_settlement iss_conv_rate_settlement_date acq_settlement_amount
acq_settlement_currency acq_settlement_date acq_conv_rate_settlement acq_conv_rate_settlement_date
services_setup_code receiving_institution acquirer_institution_code acquirer_bank
card_acceptor_activity tcc card_acceptor_term_id card_acceptor_id card_acc_name_address
pos_entry_mode pos_condition_code pos_data forwarding_country_code forwarding_institution_code
forwarding_bank authorization_length authorization_code original_authorization_code
authorization_source security_verif_level security_verif_result reject_code reject_reason reason_code
origine_code original_transaction_date_time reversal_stan reversal_transaction_date autho_flag
reversal_flag transaction_flag matching_status matching_date matching_level matching_date_purge
private_tlv_data authorization_id transaction_id user_create date_create user_modif date_modif
internal_stan external_stan reference_number routing_code capture_code acquirer_resource_code
acquiring_country_code card_number card_sequence_number chip_cryptogram_info_data
destination_account_code destination_account_entity_cod destination_account_entity_id
destination_account_number destination_account_type end_expiry_date external_cvv_result_code
issuer_resource_code limit_id limit_index network_data network_id original_table_indicator
service_code source_account_code source_account_entity_code source_account_entity_id
source_account_number source_account_type start_expiry_date current_table_indicator
""".split())

OPERATION_TEXT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in OPERATION_COLUMNS])

# A record holds every text column of the table, named in upper case.
RECORD_COLUMNS = tuple(c.upper() for c in OPERATION_COLUMNS)

# The columns the stages read, named as they are inside a payload.
PAYLOAD_COLUMNS = tuple("""
MESSAGE_TYPE CARD_NUMBER TRANSACTION_AMOUNT TRANSACTION_CURRENCY BILLING_CURRENCY
TRANSACTION_LOCAL_DATE CARD_ACCEPTOR_ACTIVITY BILLING_AMOUNT ISS_SETTLEMENT_AMOUNT
ISS_SETTLEMENT_CURRENCY CASH_BACK_AMOUNT TRANSMISSION_DATE_AND_TIME BUSINESS_DATE CAPTURE_DATE
END_EXPIRY_DATE PROCESSING_CODE ACTION_CODE ORIGINAL_ACTION_CODE CARD_SEQUENCE_NUMBER
CARD_ACCEPTOR_ID CARD_ACC_NAME_ADDRESS CARD_ACCEPTOR_TERM_ID ACQUIRER_INSTITUTION_CODE ACQUIRER_BANK
ACQUIRING_COUNTRY_CODE ISSUING_BANK NETWORK_CODE INTERNAL_STAN REFERENCE_NUMBER AUTHORIZATION_CODE
AUTHORIZATION_SOURCE ORIGINAL_AUTHORIZATION_CODE
""".split())

STRING_MAP = "map<string,string>"

# Stage stamps, in the order the stages add them.
PROCESSING_DDL = (
    "struct<cdcOp:string,cdcIngestedAt:bigint,decryptedAt:bigint,"
    "validatedAt:bigint,normalizedAt:bigint>"
)
PROCESSING_FIELDS = ("cdcOp", "cdcIngestedAt", "decryptedAt", "validatedAt", "normalizedAt")

# Envelope members other than the payload, all optional.
ENVELOPE_HEAD = ("eventId", "schemaVersion", "source", "producedAt", "eventTime")
ENVELOPE_HEAD_TYPES = {
    "eventId": "string",
    "schemaVersion": "string",
    "source": "string",
    "producedAt": "bigint",
    "eventTime": "string",
}

_AMOUNT = "struct<value:double,currencyCode:string,currencyAlpha:string,minorUnits:int>"

# The canonical record.
CANONICAL_DDL = f"""struct<
msgId:string, schema:string, creDtTm:string, businessDate:string,
iso8583:struct<mti:string,mtiName:string,processingCode:string,actionCode:string,responseCode:string>,
transaction:struct<amount:{_AMOUNT},billingAmount:{_AMOUNT},settlementAmount:{_AMOUNT},
cashBackAmount:{_AMOUNT},transactionLocalDate:string,captureDate:string>,
card:struct<panMasked:string,panBin:string,scheme:string,expiryDate:string,sequenceNumber:string>,
merchant:struct<id:string,name:string,mcc:string,mccDescription:string,terminalId:string>,
acquirer:struct<institutionCode:string,bank:string,countryCode:string>,
issuer:struct<bank:string,networkCode:string>,
audit:struct<stan:string,rrn:string,authCode:string,authSource:string,originalAuthCode:string>,
_processing:{PROCESSING_DDL}
>""".replace("\n", "")
