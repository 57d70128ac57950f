"""The registered queries, their inputs and the SQL that checks them."""
