"""Sales data mart on Spark: raw CRM and ERP extracts -> clean tables -> star schema -> reports."""
