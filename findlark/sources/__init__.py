"""Reading: content rows, stored records, attachments and page corpora."""
