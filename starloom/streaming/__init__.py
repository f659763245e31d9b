"""Raw tables read as they grow."""
