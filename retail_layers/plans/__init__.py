"""The retail data model: table rules for each layer and the runs that build them."""
